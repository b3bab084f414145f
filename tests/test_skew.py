"""Joins with hot and missing keys: same rows as the plain join, hot keys spread over tasks."""

import pytest
from pyspark.sql import functions as F

from shelfwise.operators.skew import hot_keys, plain_join, skew_join


@pytest.fixture(scope="module")
def sides(spark):
    n = F.col("id")
    key = F.when(n % 2 == 0, 7).when(n % 29 == 0, None).otherwise(n % 997)  # half of the rows share one key
    probe = spark.range(60_000).select(key.cast("long").alias("item_id"), n.alias("user_id"), (n % 5).alias("label"))
    build = spark.range(900).select(n.alias("item_id"), F.concat(F.lit("genre "), (n % 11).cast("string")).alias("genre"))
    # a key that stands twice, one without a value and one that is missing
    more = spark.createDataFrame([(7, "second"), (8, None), (None, "nobody")], "item_id long, genre string")
    return probe, build.unionByName(more)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_rows_equal_the_plain_join(sides, how):
    got, expected = skew_join(*sides, "item_id", how), plain_join(*sides, "item_id", how).select("item_id", "user_id", "label", "genre")
    assert got.columns == expected.columns
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_hot_keys_name_the_hot_one(sides):
    hot = dict(hot_keys(sides[0], "item_id", 8))
    assert hot[7] >= 60 and len(hot) < 10


def test_hot_key_is_spread_without_adaptive_execution(spark, sides):
    probe, build = sides
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    try:
        joined = skew_join(probe.where("item_id IS NOT NULL"), build.dropDuplicates(["item_id"]), "item_id", "inner")
        tasks = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect())
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
    assert len(tasks) == 8 and tasks[-1] < 2 * tasks[4]


def test_empty_sides_and_other_joins(spark, sides):
    probe, build = sides
    assert skew_join(probe.limit(0), build, "item_id").isEmpty()
    assert skew_join(probe, build.limit(0), "item_id", "inner").isEmpty()
    assert skew_join(probe, build.limit(0), "item_id", "left").count() == 60_000
    with pytest.raises(ValueError, match="full"):
        skew_join(probe, build, "item_id", "full")
