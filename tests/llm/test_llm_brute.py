"""Operators that SQL can't express, against brute force, exact round trips and held-out accuracy."""

import hashlib
import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from shelfwise.llm import (components, decontaminate, exact_dedup, fuse_filter, html_text, packing, queries, quality,
                           repeats, simhash, substring, suffix, toxicity, warc)
from shelfwise.llm.common import keyed

SF = "/root/testdata/sf0.001"
SF2 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def texts(docs):
    return {r[0]: (r[1] or "") for r in docs.collect()}


def groups(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# --- hashing, filters, components -------------------------------------------------

@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(0, 2 ** 64 - 1), max_size=3000), st.integers(0, 2 ** 32))
def test_fuse_filter(keys, seed):
    blob = fuse_filter.build(np.array(sorted(keys), np.uint64))
    assert fuse_filter.contains(blob, np.array(sorted(keys), np.uint64)).all()
    others = np.random.default_rng(seed).integers(0, 2 ** 63, 5000).astype(np.uint64)
    assert fuse_filter.contains(blob, others).sum() <= 5


def test_fuse_filter_is_small():
    keys = np.random.default_rng(1).integers(0, 2 ** 63, 100_000).astype(np.uint64)
    assert len(fuse_filter.build(keys)) < 2.4 * len(keys)


def test_components(spark):
    rnd = random.Random(3)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + k) for k in range(1, 40)] + [(rnd.randrange(200, 300), rnd.randrange(200, 300)) for _ in range(60)]
    want = groups(links, {x for a, b in links for x in (a, b) if a != b})
    got = {r[0]: r[1] for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {n: r for n, r in want.items() if any(n in e and e[0] != e[1] for e in links)}


# --- SimHash ----------------------------------------------------------------------

def simhash_brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = [w.decode() for w in low.encode().split()]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_query(spark, texts):
    got = {r[0]: (r[1], r[2]) for r in queries.op3_simhash(spark, SF).collect()}
    fps = {d: simhash_brute(t) for d, t in texts.items()}
    links = [(a, b) for a, b in itertools.combinations(sorted(fps), 2) if (fps[a] ^ fps[b]).bit_count() <= 2]
    want = groups(links, fps)
    assert got == {d: (f"{fps[d]:016x}", want[d]) for d in fps}


@pytest.mark.parametrize("short", [1, 32])
@pytest.mark.parametrize("max_bits", [0, 1, 2])
def test_links_give_all_components(spark, short, max_bits):
    rnd = random.Random(5)
    fps = {0, -1}
    for _ in range(12):
        base = rnd.getrandbits(64)
        for _ in range(40):
            fp = base
            for _ in range(rnd.choice((0, 1, 1, 2, 2, 3))):
                fp ^= 1 << rnd.randrange(64)
            fps.add(fp - (1 << 64) if fp >> 63 else fp)
            base = fp if rnd.random() < 0.4 else base
    pairs = [(a, b) for a, b in itertools.combinations(sorted(fps), 2) if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= max_bits]
    found = [tuple(r) for r in simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), max_bits, short).collect()]
    assert all(((a ^ b) & (2 ** 64 - 1)).bit_count() <= max_bits for a, b in found)
    assert groups(found, fps) == groups(pairs, fps)


# --- repeats ------------------------------------------------------------------------

def windows_brute(rows, words, length, within):
    """Removed units per document of ``(order, text)`` rows."""
    first, out = {}, {}
    units = {k: (t.split() if words else list(t)) for k, t in rows}
    for k in sorted(units):
        for i in range(len(units[k]) - length + 1):
            first.setdefault(tuple(units[k][i:i + length]), (k, i))
    for k, u in units.items():
        gone = [False] * len(u)
        for i in range(len(u) - length + 1):
            d, at = first[tuple(u[i:i + length])]
            if d < k or within and at < i:
                gone[i:i + length] = [True] * length
        out[k] = gone
    return out


def frame_in_process(rows, rule, routes=3, batch=2):
    """The steps of ``repeated_windows`` on plain lists: what Spark deals out by route and document."""
    import pyarrow as pa

    schema = pa.schema([("route", pa.int32()), ("kind", pa.int32()), ("ord", pa.int64()), ("h", pa.int64()), ("data", pa.binary())])

    def dealt(batches):
        table = pa.Table.from_batches(list(batches), schema).to_pylist()
        return [pa.RecordBatch.from_pylist(sorted(table, key=lambda r: r["route"]), schema)] if table else []

    found = []
    for i in range(0, len(rows), batch):  # each slice is a task
        part = rows[i:i + batch]
        b = pa.RecordBatch.from_arrays([pa.array([k for k, _ in part], pa.int64()), pa.array([0] * len(part), pa.int64()), pa.array([t.decode() for _, t in part])], ["ord", "h", "text"])
        found += repeats._find(rule, routes)(iter([b]))
    met = pa.Table.from_batches(list(repeats._meet(rule, routes)(dealt(found))), schema).to_pylist()
    opened = defaultdict(list)
    for r in met:
        if r["kind"] == repeats.OPEN:
            opened[r["ord"]].append(r["data"])
    text = dict(rows)
    b = pa.RecordBatch.from_pylist([{"ord": k, "h": 0, "text_z": repeats.pack(text[k]), "open": v} for k, v in opened.items()],
                                   pa.schema([("ord", pa.int64()), ("h", pa.int64()), ("text_z", pa.binary()), ("open", pa.list_(pa.binary()))]))
    solved = pa.Table.from_batches(list(repeats._resolve(rule, routes)(dealt(repeats._fetch(rule, routes)(iter([b]))))), schema).to_pylist()
    ranges = defaultdict(list)
    for r in [*met, *solved]:
        if r["kind"] == repeats.SETTLED:
            ranges[r["ord"]].append(r["data"])
    return {k: repeats.covered(ranges.get(k), len(t.split()) if rule.words else len(t), rule.length).tolist() for k, t in rows}


@pytest.mark.parametrize("hot", [2, 32])
@pytest.mark.parametrize("limit", [1, 64])
@settings(max_examples=25, deadline=None)
@given(data=st.data())
def test_words_frame(hot, limit, data):
    repeats.HOT_CONTEXTS = hot
    rule = substring.rule(5, 2)
    rule = repeats.Rule(**{**rule.__dict__, "group_limit": limit})
    rows = [(k, " ".join(w).encode()) for k, w in enumerate(data.draw(st.lists(st.lists(st.sampled_from("ab"), max_size=25), min_size=1, max_size=8)))]
    assert frame_in_process(rows, rule) == windows_brute(rows, True, 5, False)


@pytest.mark.parametrize("hot", [2, 32])
@pytest.mark.parametrize("limit", [1, 2048])
@settings(max_examples=25, deadline=None)
@given(data=st.data())
def test_bytes_frame(hot, limit, data):
    repeats.HOT_CONTEXTS = hot
    rule = suffix.rule(12, 8)
    rule = repeats.Rule(**{**rule.__dict__, "group_limit": limit})
    rows = [(k, t.encode()) for k, t in enumerate(data.draw(st.lists(st.text("ab", max_size=60), min_size=1, max_size=6)))]
    assert frame_in_process(rows, rule) == windows_brute(rows, False, 12, True)


@settings(max_examples=60, deadline=None)
@given(st.text("ab", min_size=30, max_size=120))
def test_longest_previous_factor(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    starts = np.arange(len(raw) - 16 + 1)
    order, common = suffix.suffix_order(raw, starts, 16)
    lpf = np.zeros(len(starts), np.int64)
    lpf[order] = suffix.longest_previous(order, common)
    for i in starts:
        best = max((next((k for k in range(16) if raw[i + k] != raw[j + k]), 16) for j in range(i)), default=0)
        assert lpf[i] == (16 if best == 16 else best // 8 * 8)


def test_suffix_query(spark, texts):
    got = {r[0]: tuple(r[1:]) for r in queries.op10_suffix_dedup(spark, SF).collect()}
    seen, want = set(), {}
    for d in sorted(texts):
        b = texts[d].encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 99):
            if b[i:i + 100] in seen:
                gone[i:i + 100] = True
            seen.add(b[i:i + 100])
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        want[d] = (len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())
    assert got == want


# --- packing ----------------------------------------------------------------------------

def check_pieces(pieces, ids):
    """``(doc, start, length, crc, tokens, sequence, offset)`` cover each document's ids once, in gapless sequences."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for d, start, n, crc, total, seq, off in pieces:
        by_doc[d].append((start, n, crc, total))
        by_seq[seq].append((off, n))
    assert set(by_doc) == set(ids)
    for d, own in by_doc.items():
        at = 0
        for start, n, crc, total in sorted(own):
            assert start == at and total == len(ids[d]) and crc == zlib.crc32(np.array(ids[d][start:start + n], "<u4").tobytes())
            at += n
        assert at == len(ids[d])
    for own in by_seq.values():
        at = 0
        for off, n in sorted(own):
            assert off == at and n > 0
            at += n
        assert at <= 4096 and at & (at - 1) == 0


def test_packing_query(spark, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_path())
    ids = {d: [*tok.encode(t, add_special_tokens=False).ids, 2] for d, t in texts.items()}
    check_pieces([tuple(r) for r in queries.op7_packing(spark, SF).collect()], ids)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 12000), min_size=1, max_size=60))
def test_pack_group(lengths):
    pieces = packing.pack_group(lengths)
    ids = {d: list(range(n)) for d, n in enumerate(lengths)}
    check_pieces([(d, s, n, zlib.crc32(np.array(ids[d][s:s + n], "<u4").tobytes()), lengths[d], q, o) for d, s, n, q, o in pieces], ids)


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("aB'.,-! \n\t é漢İΣß1<|>")), max_size=60))
def test_cached_tokenizer(text):
    tok = test_cached_tokenizer.__dict__.setdefault("tok", packing.CachedTokenizer(queries.tokenizer_path()))
    assert np.frombuffer(tok.encode(text.encode()), "<u4").tolist() == tok.whole.encode(text, add_special_tokens=False).ids


# --- exact duplicates, decontamination -------------------------------------------------

def test_snapshot_split_makes_no_difference(spark, docs):
    from pyspark.sql import functions as F

    a = exact_dedup.as_contract(exact_dedup.deduplicate(docs, bucket_keys=16))
    b = exact_dedup.as_contract(exact_dedup.deduplicate(docs, F.lit(False)))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_decontaminated_text_has_no_window(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    found = decontaminate.find_contamination(docs, bench, flags=True)
    left = decontaminate.without_spans(docs, found).select("ord", "text").withColumnRenamed("ord", "doc_id")
    kept = {r["ord"]: r["n_words"] - r["n_hit"] for r in found.collect()}
    for r in decontaminate.find_contamination(left, bench).collect():
        assert r["n_words"] == kept[r["ord"]]


# --- archives ---------------------------------------------------------------------------

def test_archive_round_trip(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    folder, index = warc.archive(pages, f"file://{tmp_path}/warc")
    want = {r["page_id"]: (r["html"] or "").encode() for r in pages.collect()}
    got = {r["ord"]: bytes(r["payload"]) for r in warc.read_bundles(spark, folder, index).where("record_type = 'response'").collect()}
    assert got and all(want[k] == v for k, v in got.items())
    for r in index.collect()[::7]:
        head, body = warc.read_record(folder, r.bundle, r.frame, r.place, r.size)
        assert head["X-Page-Ord"] == str(r.ord) and (body == want[r.ord] or head["WARC-Type"] == "revisit")
    for path in (tmp_path / "warc").glob("*.zst"):  # any Zstandard reader can unpack a bundle
        raw = path.read_bytes()
        data = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
        assert data.startswith(b"WARC/1.1\r\n") and sum(s for _, s in warc.frames_of(raw)) == len(data)


# --- page text --------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>if (a < b) "<p>"</script></head><body class="home">
<header><a href=/>Site</a><p>Slogan of the site</p></header><nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav>
<div class="cookie-notice"><p>We use cookies, please agree to them all, it is for your own good.</p></div>
%s
<aside><p>Popular: something else entirely, with many words in it.</p></aside>
<section id="comments"><p>Great article, I learnt so much from it, thank you all very much!</p></section>
<form><label>Mail</label><input name=q><button>Go</button></form><footer>&copy; 2020 <a href=x>Imprint</a></footer></body></html>"""
BODY = "<h1>Head &amp; line</h1><p>First <b>bold</b>\n  text&nbsp;here, it has some words.</p><p>Second one<br>with a break, and <a href=z>a link</a>.<p>Third &lt;unclosed&gt;"
WANT = "Head & line\n\nFirst bold text here, it has some words.\n\nSecond one with a break, and a link.\n\nThird <unclosed>"


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main><article>%s</article></main>", "<div class=wrap><div id=content>%s</div></div>", "<main>%s</main>"])
def test_page_text(wrap):
    assert html_text.extract(PAGE % (wrap % BODY)) == WANT


def test_page_query(spark):
    """Against the known frame of the synthetic pages, cut out with patterns."""
    import html
    import re

    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in queries.op8_html_text(spark, SF2).collect()}
    for r in spark.read.parquet(f"{SF2}/pages.parquet").collect():
        body = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?p>|</?h1>", body)]
        want = "\n\n".join(x for x in parts if x)
        assert got[r["page_id"]] == (want, len(want))


# --- classifiers --------------------------------------------------------------------------

def held_out_rates(df, labels, label):
    r = df.where("held_out").join(labels, "doc_id").select("predicted", label).collect()
    return {y: np.mean([p == y for p, t in r if t == y]) for y in (0, 1)}


def test_quality_held_out(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rates = held_out_rates(queries.op2_quality(spark, "/root/testdata/sf0.1"), labels, "quality")
    assert rates[0] > 0.8 and rates[1] > 0.97


def test_toxicity_held_out(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rates = held_out_rates(queries.op5_toxicity(spark, "/root/testdata/sf0.1"), labels, "toxic")
    assert rates[0] > 0.97 and rates[1] > 0.8


def test_forward_backward_is_exact():
    rnd = np.random.default_rng(2)
    model = toxicity.Field(steps=rnd.normal(size=(2, 2)), begin=rnd.normal(size=2))
    texts = [b"a b c", b"", b"d", b"e f g h i", b"j k"]
    t = toxicity.Tokens.of(texts)
    model.own[t.words] = rnd.normal(size=len(t.words)) * 2
    p, pairs, begins = model.expectations(t, pairs=True)
    e = model.energies(t, t.starts())
    want_pairs = np.zeros((2, 2))
    for lo, hi in zip(t.first[:-1], t.first[1:]):
        weight, marg, both = 0.0, np.zeros(hi - lo), np.zeros((2, 2))
        for states in itertools.product((0, 1), repeat=int(hi - lo)):
            if not states:
                continue
            s = model.begin[states[0]] + sum(e[lo + i] * x for i, x in enumerate(states)) + sum(model.steps[a, b] for a, b in zip(states, states[1:]))
            w = np.exp(s)
            weight += w
            marg += w * np.array(states)
            for a, b in zip(states, states[1:]):
                both[a, b] += w
        if hi > lo:
            assert np.allclose(p[lo:hi], marg / weight)
            want_pairs += both / weight
    assert np.allclose(pairs, want_pairs)


# --- pipeline ------------------------------------------------------------------------------

def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]
    run = dict(corpus_pipeline.STAGES)
    have = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    score = {r["doc_id"]: r["score"] for r in queries.op5_toxicity(spark, SF).collect()}
    clean = run["toxicity"](spark, docs, SF)
    assert clean.columns == docs.columns
    left = {d: t for d, t in have.items() if score[d] < 0.3}
    assert {r["doc_id"] for r in clean.collect()} == set(left)
    best = {}
    for d, t in left.items():
        key = t.encode().translate(None, b" \t\n\x0b\x0c\r")
        best[key] = min(best.get(key, (1, 0)), (-len(t), d))
    left = {d: left[d] for _, d in best.values()}
    single = run["exact_dedup"](spark, clean, SF)
    assert {r["doc_id"] for r in single.collect()} == set(left)
    fps = {d: simhash_brute(t) for d, t in left.items()}
    root = groups([(a, b) for a, b in itertools.combinations(sorted(fps), 2) if (fps[a] ^ fps[b]).bit_count() <= 2], fps)
    left = {d: t for d, t in left.items() if root[d] == d}
    near = run["near_dedup"](spark, single, SF)
    assert {r["doc_id"] for r in near.collect()} == set(left)
    hit = {r["doc_id"] for r in queries.op4_decontaminate(spark, SF).where("contaminated").collect()}
    fine = run["decontamination"](spark, near, SF)
    assert {r["doc_id"] for r in fine.collect()} == set(left) - hit
    assert {r["doc_id"] for r in run["packing"](spark, fine, SF).collect()} == set(left) - hit
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect()} == set(left) - hit


def test_keyed_orders_null_ids_last(spark):
    rows = keyed(spark.createDataFrame([(None, None), (1, "a")], "doc_id long, text string")).collect()
    assert sorted(r["ord"] for r in rows) == [1, 2 ** 63 - 1] and {r["text"] for r in rows} == {"", "a"}


def test_repeated_line_is_not_paired_with_itself():
    """A line that one document repeats often has many rows of few contexts: they aren't all paired."""
    line = " ".join(f"w{i}" for i in range(9))
    rows = [(0, (" ".join([line] * 300) + " a b c d e f").encode()), (1, f"x y z {line} {line} u v".encode())]
    sizes = []

    def resolve(rule, group):
        sizes.extend(np.unique(group["a"], return_counts=True)[1].tolist())
        return substring.extend(rule, group)

    rule = repeats.Rule(**{**substring.rule(5, 2).__dict__, "resolve": resolve})
    assert frame_in_process(rows, rule) == windows_brute(rows, True, 5, False)
    assert max(sizes, default=0) <= rule.group_limit
