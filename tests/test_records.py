"""Records of files with quoted newlines, cut in splits, against pandas; order and file ranges of written splits."""

import io
import os
import random
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.sources import records, tsv


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def use(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "0")

    yield use
    for n, v in before.items():
        spark.conf.set(n, v)


def _file(text, name="f.tsv"):
    folder = tempfile.mkdtemp(prefix="shelfwise-records-")
    with open(os.path.join(folder, name), "w", newline="", encoding="utf-8") as f:
        f.write(text)
    return folder


def _awkward(seed, wide):
    rnd = random.Random(seed)
    rows = []
    for _ in range(rnd.randrange(1, 40)):
        row = []
        for _ in range(4):
            v = "".join(rnd.choice(["a", "b", " ", '"', "\n", "\t", "é", '""', 'x"y']) for _ in range(rnd.choice([0, 1, 3, 8, 60 if wide else 5])))
            if rnd.random() < 0.3:
                v = v.replace("\n", "").replace("\t", "")
            row.append('"' + v.replace('"', '""') + '"' if any(c in v for c in "\t\n") or v.startswith('"') else v)
        rows.append("\t".join(row))
    return "\n".join(rows) + ("\n" if seed % 2 else "")


@pytest.mark.parametrize("seed", range(6))
def test_records_equal_pandas_in_any_split(spark, small_splits, seed):
    text = _awkward(seed, wide=seed % 3 == 0)
    expected = pd.read_csv(io.StringIO(text, newline=""), sep="\t", header=None, names=range(4), dtype=str, keep_default_na=False,
                           na_filter=False, engine="c").values.tolist()
    folder = _file(text)
    for size in (23, 1 << 20):
        small_splits(size)
        got = sorted((r["line"], list(r["fields"])) for r in records.read_records(spark, folder).collect())
        assert [(f + [""] * 4)[:4] for _, f in got] == [[str(v) for v in r] for r in expected]


def test_many_splits_are_used_and_nothing_is_sorted(spark, small_splits):
    small_splits(64)
    folder = _file("".join(f"{k}\tvalue {k}\n" for k in range(500)))
    df = records.read_records(spark, folder)
    assert df.count() == 500
    assert df.where(F.col("line") != F.col("fields")[0].cast("long") + 1).isEmpty()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Scan ExistingRDD" not in plan
    assert spark.read.text(folder).rdd.getNumPartitions() > 4


def test_line_numbers_restart_in_each_file(spark, small_splits):
    small_splits(32)
    folder = _file("a\tb\n" * 30, "one.tsv")
    with open(os.path.join(folder, "two.tsv"), "w") as f:
        f.write('c\t"d\n\ne"\n\nf\tg\n')
    got = sorted((r["file"][-7:], r["line"], tuple(r["fields"])) for r in records.read_records(spark, folder).collect())
    assert got[:30] == [("one.tsv", k, ("a", "b")) for k in range(1, 31)]
    assert got[30:] == [("two.tsv", 1, ("c", "d\n\ne")), ("two.tsv", 5, ("f", "g"))]


def test_carriage_returns_and_blank_lines(spark):
    folder = _file('1\ta\r\n\r\n  \r\n2\t"b\r\nc"\r\n')
    assert sorted(tuple(r["fields"]) for r in records.read_records(spark, folder).collect()) == [("1", "a"), ("2", "b\r\nc")]
    assert records.read_records(spark, _file("")).collect() == []


def test_quote_without_end_names_the_line(spark, small_splits):
    for size in (8, 1 << 20):
        small_splits(size)
        with pytest.raises(Exception, match="quote without end.*line 2"):
            records.read_records(spark, _file('1\ta\n2\t"open\nmore\nand more\n')).collect()


def test_item_features_with_torn_rows(spark, small_splits):
    small_splits(20)
    rows = [(1, "a\nb", 'say "x"', "tab\there", "", "x,\ny,"), (2, None, "NA", '"', "\n", "z,"), (3, "p", "q", "r", "s", "t,")]
    out = os.path.join(tempfile.mkdtemp(prefix="shelfwise-records-"), "features")
    tsv.write_tsv(spark.createDataFrame(rows, schemas.ITEM_FEATURES).coalesce(1), out)
    got = sorted(tuple(r) for r in tsv.read_item_features(spark, out).collect())
    assert got == [(1, "a\nb", 'say "x"', "tab\there", None, "x,\ny,"), (2, None, None, '"', "\n", "z,"), (3, "p", "q", "r", "s", "t,")]


@pytest.mark.parametrize("read, body, error", [
    (tsv.read_interactions, "1\t2\t1\nabc\t3\t1\n", "abc"),
    (tsv.read_interactions, "1\t2\t1\t9\n", "malformed"),
    (tsv.read_ground_truth, "1\t2\t1\n1\t\t1\n", "malformed"),
    (tsv.read_ground_truth, "1\t2\n", "malformed"),
    (tsv.read_item_features, "1\ta\tb\tc\td\te\nx\ta\tb\tc\td\te\n", "line 2"),
    (tsv.read_item_features, "1\ta\tb\tc\td\te\tf\n", "line 1"),
    (tsv.read_examples, "1\t2\tyes\ta\tb\n", "line 1"),
    (tsv.read_predictions, "1\t2\n1\tx\n", "line 2"),
])
def test_bad_records_end_the_job_with_their_place(spark, read, body, error):
    with pytest.raises(Exception, match="malformed line in .*f.tsv.*" + ("" if error == "malformed" else error)):
        read(spark, _file(body)).collect()


def test_missing_ids_stay_null_where_the_original_infers_types(spark):
    got = sorted(tsv.read_interactions(spark, _file('1\t2\t1\nNA\t3\t0\n4\t"5"\t\n6.0\t7\t1.0\n')).collect(), key=lambda r: r["item_id"])
    assert [tuple(r) for r in got] == [(1, 2, 1), (None, 3, 0), (4, 5, None), (6, 7, 1)]


def test_entities_of_a_split_file_keep_their_order(spark, small_splits):
    small_splits(128)
    folder = _file("head\tone\n0\ttwo\n" + "".join(f"{1000 - k}\tp{k}\n" for k in range(200)))
    got = [r["id"] for r in tsv.read_entities(spark, folder).orderBy("seq").collect()]
    assert got == [1000 - k for k in range(200)]


def test_predictions_of_a_split_file_keep_their_ranks(spark, small_splits):
    small_splits(96)
    folder = _file("".join(f"{k % 3}\t{k}\n" for k in range(300)), "run-x.txt")
    got = {(r["user_id"], r["item_id"]): r["rank"] for r in tsv.read_predictions(spark, folder).collect()}
    assert got == {(k % 3, k): k // 3 + 1 for k in range(300)}


def test_splits_are_written_in_one_job_in_order(spark):
    rows = [(u, i, 1, "", "", s) for k, s in enumerate(("train", "dev", "test")) for u in range(40) for i in range(k, 20, 2)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, label int, user_genres string, item_genre string, split string").orderBy(F.rand(1))
    out = os.path.join(tempfile.mkdtemp(prefix="shelfwise-records-"), "examples")
    tsv.write_splits(df, out)
    for s in ("train", "dev", "test"):
        folder = os.path.join(out, f"split={s}")
        files = sorted(f for f in os.listdir(folder) if f.startswith("part-"))
        read = [[tuple(map(int, line.split("\t")[:2])) for line in open(os.path.join(folder, f))] for f in files]
        whole = [r for f in read for r in f]
        assert whole == sorted(whole) and len(whole) == sum(r[5] == s for r in rows)
        assert all(a[-1] <= b[0] for a, b in zip(read, read[1:]))
        assert [tuple(r) for r in tsv.read_examples(spark, folder, with_seq=True).orderBy("seq").select("user_id", "item_id").collect()] == whole
