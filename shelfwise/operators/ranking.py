"""Exact row numbers inside groups that never put a whole group in one task.

``row_number() OVER (PARTITION BY g ORDER BY o)`` sends every row of a group to
one task; one user holding a third of the log would then be sorted by a single
core. Instead:

1. a sample of the distinct sort keys, of about ``SAMPLE`` keys at any size of the input,
   gives ``CHUNKS`` cutting points of the whole table. Which keys are sampled
   follows from a hash of the keys and the number of rows alone;
2. the rows are dealt by (group, chunk), the chunk being the place of the key
   among the cutting points, and numbered there. A group's chunk is part of the
   table's chunk, so no task gets much more than its share of the table, whatever
   the groups are;
3. a table of row counts per (group, chunk), at most ``CHUNKS`` rows a group,
   says by its running sum how many rows of a group lie in earlier chunks. Its join
   finds the rows dealt already.

The rows are shuffled once, nothing is stored and no job runs before the result is
asked for: the count and the sample are scalar subqueries. The input is read for
each of them, so an input that is dear to compute or not deterministic (model
scores) should be a stored table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE = 4096
CHUNKS = 256
_HASH_RANGE = float(1 << 63)


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _cutting_points(keyed: DataFrame) -> DataFrame:
    """One row: the sorted cutting points, fewer than ``CHUNKS``."""
    n = keyed.agg(F.count(F.lit(1)).alias("n")).scalar()
    place = F.abs(F.xxhash64("_group", "_key").bitwiseOR(F.lit(1))).cast("double")
    sampled = keyed.where(place * n <= F.lit(_HASH_RANGE * SAMPLE)).select("_key").distinct()
    keys = sampled.agg(F.array_sort(F.collect_list("_key")).alias("keys"))
    step = F.ceil((F.size("keys") + 1) / F.lit(CHUNKS))
    return keys.select(F.filter("keys", lambda x, i: (i + 1) % step == 0))


def _with_chunk(keyed: DataFrame, cuts: Column) -> DataFrame:
    """``keyed`` with ``_chunk``, the number of cutting points before the key, by binary search."""
    out = keyed.withColumns({"_cuts": cuts, "_chunk": F.lit(0)})
    width = CHUNKS // 2
    while width:
        beyond = F.get("_cuts", F.col("_chunk") + (width - 1)) < F.col("_key")
        out = out.withColumn("_chunk", F.when(beyond, F.col("_chunk") + width).otherwise(F.col("_chunk")))
        width //= 2
    return out.drop("_cuts")


def rank_within_groups(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[str | Column],
    rank_col: str = "rank",
    size_col: str | None = None,
) -> DataFrame:
    """Add ``rank_col`` = row_number() over (partition by group order by order).

    ``order_cols`` are ascending, NULL first; order a number descending by its
    negative. Ranks are 1-based BIGINT. ``size_col`` (optional) receives the group
    size. Null group keys form their own group, as in a window; without group
    columns the whole table is one group. Rows of equal keys in a group are
    numbered in any order, and stand in one task.
    """
    keyed = df.withColumns({
        # a struct compares NULLs as equal, so groups with a NULL key meet their counts by a plain join
        "_group": F.struct(*group_cols) if group_cols else F.lit(0),
        "_key": F.struct(*[_as_col(c).alias(f"k{i}") for i, c in enumerate(order_cols)]),
    })
    dealt = _with_chunk(keyed, _cutting_points(keyed).scalar())
    group = Window.partitionBy("_group")
    before = group.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("_group", "_chunk").agg(F.count(F.lit(1)).alias("_n")).select(
        "_group", "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        *([F.sum("_n").over(group).alias(size_col)] if size_col else []))
    numbered = dealt.withColumn("_place", F.row_number().over(Window.partitionBy("_group", "_chunk").orderBy("_key")))
    # The merge join keeps the rows where they are; AQE could otherwise broadcast them
    # when they are small and stream the counts through very few tasks.
    joined = numbered.join(counts.hint("merge"), ["_group", "_chunk"], "inner")
    rank = (F.col("_before") + F.col("_place")).cast("long")
    return joined.select(*df.columns, rank.alias(rank_col), *([size_col] if size_col else []))


def rank_within_groups_window(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[str | Column],
    rank_col: str = "rank",
    size_col: str | None = None,
) -> DataFrame:
    """Plain window formulation; one task per group. Kept for comparison/tests."""
    w = Window.partitionBy(*group_cols)
    out = df.withColumn(
        rank_col, F.row_number().over(w.orderBy(*[_as_col(c) for c in order_cols])).cast("long")
    )
    if size_col:
        out = out.withColumn(size_col, F.count(F.lit(1)).over(w))
    return out
