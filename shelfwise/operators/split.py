"""Reproducible stratified per-user train/dev split.

For each user with ``n`` rows, ``rint(frac * n)`` rows (round half to even, as
Python's ``round``) go to dev, the rest stay in train. Which rows: the first
ones in the order ``md5(seed|user|item), item_id, label``, a per-user
independent pseudo-random order that is engine- and partitioning-neutral.
Rows are never matched by value: duplicated (user, item) rows stay distinct.
Rows with a NULL user always stay in train.

A hot user's rows are never in one task: the order key is a hash, so its first two
hex digits deal the rows of a user with more than ``HOT_ROWS`` evenly over 256 buckets. Rows are
ranked inside their (user, bucket); the rows in smaller buckets come from a table of
counts with at most 256 rows a hot user. Other users have one bucket and need none.
Hot users are fewer than one in ``HOT_ROWS`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.fixed_values import DEV_FRACTION, SPLIT_SEED
from shelfwise.operators.ranking import rank_within_groups_window

#: Rows of a user that one task ranks at once.
HOT_ROWS = 10_000


def sample_key(seed: int) -> Column:
    return F.md5(
        F.concat_ws("|", F.lit(str(seed)), F.col("user_id").cast("string"), F.col("item_id").cast("string"))
    )


def _ranked_by_bucket(rows: DataFrame, seed: int) -> DataFrame:
    """``rows`` with ``_rk``, the place in the user's order, and ``_n``, the user's rows."""
    hot = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("_all")).where(F.col("_all") > HOT_ROWS)
    keyed = rows.join(F.broadcast(hot), "user_id", "left")
    keyed = keyed.withColumn("_bucket", F.when(F.col("_all").isNotNull(), F.substring(sample_key(seed), 1, 2)).otherwise(""))
    by_user = Window.partitionBy("user_id").orderBy("_bucket")
    # at most 256 rows a hot user
    counts = keyed.where(F.col("_all").isNotNull()).groupBy("user_id", "_bucket").agg(F.count("*").alias("_here")).select(
        "user_id", "_bucket",
        (F.sum("_here").over(by_user.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_here")).alias("_before"),
    )
    one = Window.partitionBy("user_id", "_bucket")
    # the order key, longer than the row, is made where the rows meet: it is not shuffled
    placed = keyed.repartition("user_id", "_bucket").withColumn("_key", sample_key(seed))
    placed = placed.withColumn("_rk", F.row_number().over(one.orderBy("_key", "item_id", "label")))
    placed = placed.withColumn("_n", F.coalesce("_all", F.count("*").over(one)))
    return placed.join(counts, ["user_id", "_bucket"], "left").withColumn("_rk", F.coalesce("_before", F.lit(0)) + F.col("_rk"))


def assign_split(
    interactions: DataFrame,
    frac: float = DEV_FRACTION,
    seed: int = SPLIT_SEED,
    skew_safe: bool = True,
) -> DataFrame:
    """Return ``user_id, item_id, label, split`` with split in {'train','dev'}."""
    if skew_safe:
        ranked = _ranked_by_bucket(interactions.where("user_id IS NOT NULL"), seed)
    else:
        order = [sample_key(seed), F.col("item_id"), F.col("label")]
        ranked = rank_within_groups_window(interactions.where("user_id IS NOT NULL"), ["user_id"], order, rank_col="_rk", size_col="_n")
    # rows without a user stay in train and out of the shuffles
    rest = interactions.where("user_id IS NULL").select("user_id", "item_id", "label", F.lit("train").alias("split"))
    is_dev = F.col("_rk") <= F.rint(F.lit(float(frac)) * F.col("_n"))
    return ranked.select(
        "user_id", "item_id", "label", F.when(is_dev, "dev").otherwise("train").alias("split")
    ).unionByName(rest)


def split_counts_by_user(split: DataFrame) -> DataFrame:
    """``user_id, n_rows, n_train, n_dev`` per user (partial aggregation)."""
    return split.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.when(F.col("split") == "train", 1).otherwise(0)).cast("long").alias("n_train"),
        F.sum(F.when(F.col("split") == "dev", 1).otherwise(0)).cast("long").alias("n_dev"),
    )
