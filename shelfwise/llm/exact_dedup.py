"""Exact duplicates: immutable snapshot filters, exact buckets, batch-internal groups.

A snapshot's distinct digests lie in digest buckets. Each bucket has one static
binary-fuse filter, built once and stored. The distinct digests of an incoming
batch are screened by their bucket's filter; only the positives are joined with
the exact buckets, where the normalised bytes of both representatives are
compared. Duplicates inside the batch are grouped on their own, by digest.

Defined results: NULL text counts as empty, empty texts are equal to each
other; a NULL id is the last choice among equal texts; of rows that repeat one
another wholly one row stays; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import fuse_filter
from shelfwise.llm.common import byte_list, keyed, original_id, small_batches, stored

#: Digests per bucket that a filter is sized for; the bucket count follows from the counted digests.
BUCKET_KEYS = 1 << 16
_BLANKS = b" \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    return F.translate(text, _BLANKS.decode(), "")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``ord, h, points, sha`` (32 bytes) of every row; texts stay in their scan task."""
    schema = "ord long, h long, points long, sha binary"

    def run(batches):
        for b in small_batches(batches, lean=True):
            sha = [hashlib.sha256(t.translate(None, _BLANKS)).digest() for t in byte_list(b.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [b.column("ord"), b.column("h"), pc.utf8_length(b.column("text")).cast(pa.int64()), pa.array(sha, pa.binary())],
                ["ord", "h", "points", "sha"])

    return keyed(docs, id_col, text_col).mapInArrow(run, schema)


def _keys(shas: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(s[8:16] for s in shas.to_pylist()), "<u8")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring("sha", 1, 7)), 16, 10).cast("long"), F.lit(buckets))


def build_filters(groups: DataFrame, buckets: int) -> DataFrame:
    """One filter per digest bucket: ``bucket, filter``."""
    def one(table: pa.Table) -> pa.Table:
        blob = fuse_filter.build(_keys(table.column("sha").combine_chunks()))
        return pa.table({"bucket": table.column("bucket")[:1], "filter": pa.array([blob], pa.binary())})

    return (groups.select(_bucket(buckets).alias("bucket"), "sha")
            .groupBy("bucket").applyInArrow(one, "bucket long, filter binary"))


def screen(incoming: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """The ``sha`` of ``incoming`` groups that their bucket's filter lets pass."""
    def one(new: pa.Table, known: pa.Table) -> pa.Table:
        shas = new.column("sha").combine_chunks() if new.num_rows else pa.array([], pa.binary())
        if not known.num_rows or not new.num_rows:
            return pa.table({"sha": pa.array([], pa.binary())})
        hit = fuse_filter.contains(known.column("filter")[0].as_py(), _keys(shas))
        return pa.table({"sha": shas.filter(pa.array(hit))})

    return (incoming.select(_bucket(buckets).alias("bucket"), "sha").groupBy("bucket")
            .cogroup(filters.groupBy("bucket")).applyInArrow(one, "sha binary"))


def _groups(rows: DataFrame) -> DataFrame:
    """Per digest: the best row and the size; combined before the shuffle, so a hot text costs one row a task."""
    return rows.groupBy("sha").agg(F.min("rank").alias("best"), F.count("*").alias("size"))


def _checked(positives: DataFrame, old: DataFrame, new: DataFrame, docs: DataFrame,
             id_col: str, text_col: str) -> DataFrame:
    """Positives whose normalised bytes equal those in the exact bucket: ``sha``."""
    pairs = (positives.join(old.select("sha", F.col("best").alias("a")), "sha")
             .join(new.select("sha", F.col("best").alias("b")), "sha"))
    ends = pairs.select("sha", F.explode(F.array(
        F.struct(F.col("a.ord").alias("ord"), F.col("a.h").alias("h"), F.lit(0).alias("side")),
        F.struct(F.col("b.ord").alias("ord"), F.col("b.h").alias("h"), F.lit(1).alias("side")))).alias("e"))
    ends = ends.select("sha", "e.*")
    body = (keyed(docs, id_col, text_col).join(ends, ["ord", "h"])
            .select("sha", "side", normalised(F.col("text")).alias("body")).dropDuplicates(["sha", "side"]))
    sides = body.groupBy("sha").agg(F.max(F.when(F.col("side") == 0, F.col("body"))).alias("a"),
                                    F.max(F.when(F.col("side") == 1, F.col("body"))).alias("b"))
    return sides.where(F.col("a") == F.col("b")).select("sha")


def deduplicate(docs: DataFrame, in_snapshot: Column | None = None, *,
                id_col: str = "doc_id", text_col: str = "text", bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """One row per input row: ``ord, h, row, sha, keep_ord, keep_row, group_size``.

    ``in_snapshot`` says, in terms of ``ord`` and ``sha``, which rows form the
    snapshot; the others are the incoming batch. By default the rows with an
    even ``ord`` are the snapshot.
    """
    split = in_snapshot if in_snapshot is not None else F.pmod(F.col("ord"), F.lit(2)) == 0
    rows = stored(
        digests(docs, id_col, text_col)
        .withColumns({"row": F.monotonically_increasing_id(), "old": split}), "digests")
    ranked = rows.withColumn("rank", F.struct((-F.col("points")).alias("points"), "ord", "row", "h"))
    old = _groups(ranked.where("old"))
    new = _groups(ranked.where("NOT old"))
    counted = rows.agg(F.approx_count_distinct("sha")).first()[0]
    buckets = max(1, -(-counted // bucket_keys))
    filters = stored(build_filters(old, buckets), "filters")
    positives = screen(new, filters, buckets)
    same = _checked(positives, old, new, docs, id_col, text_col).withColumn("same", F.lit(True))
    # The batch's groups that aren't in the snapshot stay groups of their own.
    merged = (old.withColumn("side", F.lit(True)).unionByName(
        new.join(same, "sha", "left").withColumn("side", F.coalesce("same", F.lit(False))).drop("same")))
    final = merged.groupBy("sha", "side").agg(F.min("best").alias("best"), F.sum("size").alias("size"))
    new_side = final.groupBy("sha").agg(  # where a batch group joined a snapshot group, there is one side only
        F.max(F.when(F.col("side"), F.struct("best", "size"))).alias("old_group"),
        F.max(F.when(~F.col("side"), F.struct("best", "size"))).alias("new_group"))
    joined = rows.join(new_side, "sha")
    group = F.when(F.col("old"), F.col("old_group")).otherwise(F.coalesce("new_group", "old_group"))
    return joined.select("ord", "h", "row", "sha", group["best"]["ord"].alias("keep_ord"),
                         group["best"]["row"].alias("keep_row"), group["size"].alias("group_size"))


def as_contract(found: DataFrame) -> DataFrame:
    return found.select(
        original_id().alias("doc_id"), original_id("keep_ord").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))
