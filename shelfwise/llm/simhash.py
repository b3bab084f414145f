"""Near duplicates by SimHash with a byte-position inverted index and count filtering.

A 64-bit fingerprint has eight positional bytes. Two fingerprints that differ
in at most two bits share at least six of them, so they share the bytes of at
least one of the fixed four-position sets below: split the positions into four
neighbouring couples, two differing bits touch two couples at most, and the
other two couples agree. Each distinct fingerprint is posted once under each of
the six sets. Fingerprints of a short posting list are paired and their shared
positional bytes tallied; pairs with fewer than six shared bytes go, the others
are verified bit by bit. A long posting list (common passages) is not paired:
its members meet at one-bit neighbours instead. Two fingerprints differ in at
most two bits exactly when some value is within one bit of both, so linking
each member to the smallest member at every such value gives the same
components, at a cost in proportion to the list's length.

Defined results: NULL and blank texts have fingerprint zero and link like any
other; texts under three words are one shingle; repeated rows share a
fingerprint; an empty table gives an empty result; a component's id is its
smallest non-NULL doc_id, or NULL if it has none; other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import byte_list, keyed, original_id, small_batches, stored
from shelfwise.llm.components import components

#: Postings up to this length are paired; longer ones are linked through one-bit neighbours.
SHORT_POSTING = 32
_LOWER = bytes(range(256)).translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))


def fingerprint(text: bytes, words: int = 3) -> int:
    """SimHash of one text, as an unsigned number."""
    parts = text.translate(_LOWER).split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        ends, starts = [len(joined)], [0]
    else:
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        stops = np.cumsum(sizes + 1) - 1
        starts = (stops - sizes)[:len(parts) - words + 1].tolist()
        ends = stops[words - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, ends)], np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.add.reduce(bits, axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(ones, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``ord, h, fp`` (signed 64-bit) of every row."""
    def run(batches):
        for b in small_batches(batches, lean=True):
            fps = np.array([fingerprint(t, words) for t in byte_list(b.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("ord"), b.column("h"), pa.array(fps.view(np.int64))], ["ord", "h", "fp"])

    return keyed(docs, id_col, text_col).mapInArrow(run, "ord long, h long, fp long")


def _byte_sets(max_bits: int) -> list[tuple[int, ...]]:
    """Position sets of which any two fingerprints within ``max_bits`` share one wholly."""
    couples = [(2 * i, 2 * i + 1) for i in range(4)]
    if not 0 <= max_bits <= 2:
        raise ValueError("the position sets are made for a distance of 0 to 2 bits")
    return [a + b for a, b in combinations(couples, 2)]


def _mask(positions: tuple[int, ...]) -> int:
    m = sum(0xFF << (8 * p) for p in positions)
    return m - (1 << 64) if m >= 1 << 63 else m


def _shared_bytes(a: Column, b: Column) -> Column:
    x = a.bitwiseXOR(b)
    return sum((x.bitwiseAND(F.lit(_mask((p,)))) == 0).cast("int") for p in range(8))


def links(distinct: DataFrame, max_bits: int = 2, short: int = SHORT_POSTING) -> DataFrame:
    """``u, v`` links between distinct fingerprints ``fp`` that yield all components."""
    masks = [_mask(s) for s in _byte_sets(max_bits)]
    posted = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("set"), F.col("fp").bitwiseAND(F.lit(m)).alias("bytes"))
        for i, m in enumerate(masks)])).alias("post")).select("fp", "post.*")
    lengths = posted.groupBy("set", "bytes").agg(F.count("*").alias("n")).where("n > 1")
    listed = posted.join(lengths, ["set", "bytes"])
    few, many = listed.where(F.col("n") <= short), listed.where(F.col("n") > short)

    left = few.select("set", "bytes", F.col("fp").alias("u"))
    right = few.select("set", "bytes", F.col("fp").alias("v"))
    tallied = (left.join(right, ["set", "bytes"]).where("v < u")
               .withColumn("shared", _shared_bytes(F.col("u"), F.col("v")))
               .where(F.col("shared") >= 8 - max_bits)
               .where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits).select("u", "v"))

    if max_bits == 0:
        return tallied
    # One-bit neighbours, only in the bits outside the shared set.
    flips = F.element_at(F.array(*[F.array(F.lit(0).cast("long"), *[
        F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(64) if not m >> b & 1])
        for m in masks]), F.col("set") + 1)
    near = many.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("at")).distinct()
    if max_bits == 1:
        centre = many.select(F.col("fp").alias("at"), F.col("fp").alias("v")).distinct()
    else:
        centre = near.groupBy("at").agg(F.min("fp").alias("v"), F.count("*").alias("n")).where("n > 1")
    starred = (near.join(centre, "at").where("fp <> v")
               .where(_shared_bytes(F.col("fp"), F.col("v")) >= 8 - max_bits)
               .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("v"))) <= max_bits)
               .select(F.col("fp").alias("u"), "v"))
    return tallied.unionByName(starred).distinct()


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 2, *, short: int = SHORT_POSTING,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``ord, h, fp, root, component_ord``; ``root`` names the component by a fingerprint of it."""
    rows = stored(fingerprints(docs, words, id_col, text_col), "fingerprints")
    per_fp = stored(rows.groupBy("fp").agg(F.min("ord").alias("low")), "distinct")
    found = links(per_fp.select("fp"), max_bits, short)
    roots = components(found)
    joined = per_fp.join(roots, per_fp.fp == roots.node, "left").withColumn("root", F.coalesce("root", "fp"))
    low = joined.groupBy("root").agg(F.min("low").alias("component_ord"))
    named = joined.join(low, "root").select("fp", "root", "component_ord")
    return rows.join(named, "fp").select("ord", "h", "fp", "root", "component_ord")


def as_contract(found: DataFrame) -> DataFrame:
    return found.select(original_id().alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        original_id("component_ord").alias("component_id"))
