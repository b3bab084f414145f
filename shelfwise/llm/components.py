"""Connected components by alternating large-star and small-star steps.

Both steps are a grouping and a join; every round is stored in the shared
folder, so the lineage stays short and a lost executor re-reads files. The
rounds' files follow from the links counted before, not from the number of
shuffle partitions: many small files cost more than the rounds themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import stored

#: Links that a file of a round is meant for.
LINKS_PER_FILE = 1 << 18


def _with_smallest(edges: DataFrame) -> DataFrame:
    """Per directed edge ``(u, v)`` the smallest node ``m`` among u and its neighbours."""
    low = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return edges.join(low, "u")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges (u, v)``; root is the smallest node reachable."""
    def print_of(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    e = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = print_of(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_smallest(both).where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # large: each node points to a smaller one; small-star ties those targets together
        small = _with_smallest(large)
        star = (small.select("v", "m").unionByName(small.select(F.col("u").alias("v"), "m"))
                .where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # A round leaves at most two links for each it took.
        e = stored(star.coalesce(max(1, -(-2 * seen[0] // LINKS_PER_FILE))), "star")
        now = print_of(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
