"""Joins whose probe side has hot or missing keys.

A join on ``item_id`` sends all rows of a popular item to one task. AQE splits such
partitions only from a size on, and only where the plan lets it. Here the hot
keys are found first, by a mergeable frequent-items sketch of the probe side
(``approx_top_k``, a fixed number of counters a task), and

* a hot key's probe rows are dealt over as many pieces as it takes, by a hash of the
  whole row; its build rows are copied once a piece. Other keys stay whole;
* probe rows without a key meet nothing: a left join keeps them beside the
  shuffle, an inner join drops them before it.

The sketch is read by the driver: at most ``HOT_KEYS`` keys with their numbers of
pieces, which both sides get as one small broadcast, so that they agree. Copies are
bounded: with ``n`` probe rows and a piece of ``n / (16 * partitions)`` rows there
are at most ``16 * partitions`` pieces of hot keys in all.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ``(probe, build, key, how) -> joined``: the operators that look something up by a key take one.
#: ``like`` names a table to read the probe's hot keys from, where the probe itself is dear to compute.
Join = Callable[..., DataFrame]

HOT_KEYS = 256
_COUNTERS = 32 * HOT_KEYS
_PIECES_A_TASK = 16


def hot_keys(probe: DataFrame, key: str, partitions: int | None = None) -> list[tuple[object, int]]:
    """``(key, pieces)`` of the keys with more rows than a piece should have; runs one aggregation over ``probe``."""
    partitions = partitions or int(probe.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = probe.where(F.col(key).isNotNull())
    top, n = known.agg(F.expr(f"approx_top_k(`{key}`, {HOT_KEYS}, {_COUNTERS})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    piece = max(n / (_PIECES_A_TASK * partitions), 1)
    return [(t["item"], math.ceil(t["count"] / piece)) for t in top or [] if t["count"] > piece]


def skew_join(probe: DataFrame, build: DataFrame, key: str, how: str = "left", hot: list[tuple[object, int]] | None = None,
              like: DataFrame | None = None) -> DataFrame:
    """``probe`` joined with ``build`` on ``key``, ``how`` being ``left`` or ``inner``.

    The result equals the plain join's, whatever ``hot`` names: a key there is a
    question of where rows meet. They are read from ``like`` if given, else from the probe, which
    is then computed twice. Columns: those of ``probe``, then the others of ``build``.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"left or inner join, not {how}")
    hot = hot_keys(probe if like is None else like, key) if hot is None else hot
    schema = T.StructType([T.StructField(key, probe.schema[key].dataType), T.StructField("_pieces", T.IntegerType())])
    pieces = F.broadcast(probe.sparkSession.createDataFrame(hot, schema))
    n = F.coalesce("_pieces", F.lit(1))
    have = probe.where(F.col(key).isNotNull()).join(pieces, key, "left")
    dealt = have.withColumn("_piece", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in probe.columns]), n).cast("int")).drop("_pieces")
    copied = build.where(F.col(key).isNotNull()).join(pieces, key, "left")
    copied = copied.withColumn("_piece", F.explode(F.sequence(F.lit(0), n - 1))).drop("_pieces")
    others = [c for c in build.columns if c != key]
    out = dealt.join(copied, [key, "_piece"], how).select(*probe.columns, *others)
    if how == "inner":
        return out
    return out.unionByName(probe.where(F.col(key).isNull()), allowMissingColumns=True)


def plain_join(probe: DataFrame, build: DataFrame, key: str, how: str = "left", like: DataFrame | None = None) -> DataFrame:
    return probe.join(build, key, how)
