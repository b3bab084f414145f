"""What keeps the work and the memory of a task in proportion to the input."""

import os
import re
import tempfile

from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.operators import features
from shelfwise.sources import fixtures, tsv
from shelfwise.fixed_values import RESOURCE_PREFIX as R


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_line_is_cut_once_whatever_is_asked_of_its_columns(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="shelfwise-growth-"), "interactions")
    rows = [(1, 2, 1, "train"), (None, 3, 0, "train"), (4, None, None, "dev"), (5, 6, 1, "test")]
    tsv.write_splits(spark.createDataFrame(rows, "user_id bigint, item_id bigint, label int, split string"), path)
    read = tsv.read_splits(spark, path)
    assert sorted(map(tuple, read.collect()), key=str) == sorted(rows, key=str)
    asked = read.where("label = 1 AND user_id IS NOT NULL AND item_id IS NOT NULL")
    assert {tuple(r) for r in asked.collect()} == {(1, 2, 1, "train"), (5, 6, 1, "test")}
    assert len(re.findall(r"\bsplit\(", _plan(asked))) == 1


def test_whole_numbers_read_as_before(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="shelfwise-growth-"), "ids.tsv")
    with open(path, "w") as f:
        f.write('1.0\t2\t1\n"3"\t4.\t0.00\nNaN\t\tNA\n')
    got = [tuple(r) for r in tsv.read_interactions(spark, path).collect()]
    assert got == [(1, 2, 1), (3, 4, 0), (None, None, None)]


def test_triples_are_dealt_to_tasks_by_the_length_of_the_log(spark, monkeypatch):
    lines = spark.range(400).select((F.col("id") % 40).alias("l_partkey"), (F.col("id") % 7).alias("l_suppkey"))
    part = spark.range(40).select(F.col("id").alias("p_partkey"), F.lit("a b").alias("p_name"), F.lit("B").alias("p_brand"),
                                  F.lit("T").alias("p_type"), F.lit(1).alias("p_size"))
    supplier = spark.range(7).select(F.col("id").alias("s_suppkey"), F.concat(F.lit("S"), (F.col("id") % 5).cast("string")).alias("s_name"))
    whole = sorted(map(tuple, fixtures.build_entity_src(part, lines, supplier).collect()))
    monkeypatch.setattr(fixtures, "ROWS_A_TASK", 8)
    dealt = fixtures.build_entity_src(part, lines, supplier)
    assert dealt.rdd.getNumPartitions() == 50
    assert sorted(map(tuple, dealt.collect())) == whole and len(set(whole)) == len(whole)


def test_first_values_are_found_by_ids_before_uris_are_aggregated(spark):
    triples = spark.createDataFrame([(1, i, 5) for i in range(10, 60)] + [(1, 3, 7), (1, 2, 7), (1, 1, 5), (1, 9, 5), (2, 99, 2), (None, 10, 2)],
                                    schemas.ITEM_PROP)
    entities = spark.createDataFrame([(1, None), (2, R + "Category:b"), (3, R + "Category:a"), (9, "no prefix")]
                                     + [(i, f"{R}p{i}") for i in range(10, 60)], schemas.ENTITIES)
    got = {r["item_id"]: r for r in features.item_features(triples, entities).collect()}
    # entity 1 has no URI; entity 9 comes first, and lacks the prefix
    assert got[1]["publisher"] is None and got[1]["subject"] == "b,a,"
    assert tuple(got[2])[1:] == (None,) * 5 and got[None]["author"] == "p10"
    kept = features._first_ids(triples, entities, features.plain_join)
    assert sorted((r["item_id"] or 0, r["id"], r["type"]) for r in kept.collect()) == [(0, 10, 2), (1, 2, 7), (1, 3, 7), (1, 9, 5)]
