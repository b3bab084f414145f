"""The fit's sums, made of a part at a time; pieces of texts that are cut out without further copies."""

import numpy as np
import pyarrow as pa

from shelfwise.llm import common, fill_middle, hashing, toxicity


def _texts():
    rng = np.random.default_rng(1)
    words = [b"ab", b"hello", b"w", b"x" * 9, b"zz-y"]
    return [b" ".join(rng.choice(words, rng.integers(0, 50))) for _ in range(60)] + [b"", b"  "], rng


def test_energies_of_parts_equal_those_of_the_whole(monkeypatch):
    texts, rng = _texts()
    model = toxicity.Field()
    model.gram[:], model.own[:] = rng.normal(size=(2, 1 << toxicity.BITS))
    t = toxicity.Tokens.of(texts)
    whole = model.energies(t, t.starts())
    for at_once in (1, 7, 100):
        monkeypatch.setattr(toxicity, "AT_ONCE", at_once)
        assert np.array_equal(model.energies(t, t.starts()), whole)


def test_support_of_parts_equals_that_of_the_whole():
    texts, _ = _texts()
    t, y = toxicity.Tokens.of(texts), np.arange(len(texts)) % 2
    whole = toxicity._support(t.first, t.words, y, 1 << 30)
    for at_once in (1, 40, 500):
        assert all(np.array_equal(a, b) for a, b in zip(toxicity._support(t.first, t.words, y, at_once), whole))
    doc = np.repeat(np.arange(len(texts)), np.diff(t.first))
    assert whole[0].sum() == sum(len(set(t.words[doc == d])) for d in range(len(texts)) if y[d])


def test_a_restored_text_is_never_split_into_an_array(spark):
    prefix, middle, suffix = "a<\n<S\n", "<<M\né>", "P>\nß<P"
    made = [("psm", f"<P>{prefix}<S>{suffix}<M>{middle}"), ("spm", f"<S>{suffix}<P>{prefix}<M>{middle}"), ("plain", "x<P><S>y<M>"),
            ("psm", "<P><S><M>ab"), ("spm", "<S><P>ab<M>"), ("psm", "<P><S>ab<M>")]
    df = spark.createDataFrame(made, "form string, output string")
    got = df.select(fill_middle.restored(df["output"], df["form"]).alias("text"))
    assert [r[0] for r in got.collect()] == [prefix + middle + suffix] * 2 + ["x<P><S>y<M>"] + ["ab"] * 3
    assert "split" not in got._jdf.queryExecution().optimizedPlan().toString().lower()


def test_rolling_hashes_are_made_of_small_pieces(monkeypatch):
    held = []
    monkeypatch.setattr(fill_middle, "Rolling", lambda data: held.append(len(data)) or hashing.Rolling(data))
    texts = ["line of text\n" * k for k in range(600)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(600), pa.int64()), "text": texts})
    made = list(fill_middle.transform([batch], fill_middle.Cache(), 7, 100, 50))
    assert sum(held) == sum(map(len, texts)) > common.SLICE_BYTES and max(held) <= fill_middle.PIECE_BYTES < common.SLICE_BYTES
    assert [i for b in made for i in b.column("doc_id").to_pylist()] == list(range(600))
