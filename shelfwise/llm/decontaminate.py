"""Benchmark decontamination: a hash set of normalised test n-grams, scanned over token windows.

The distinct windows of the benchmark items are counted first. Up to
``BROADCAST_WINDOWS`` of them they are broadcast (24 bytes and one item list
each) and every document is scanned in its scan task, without a shuffle. Beyond
that bound the same scan runs once per block of windows, each block within the
bound, and the hits are united: slower, but whole. A hash hit is verified
against the window's words before it counts.

Defined results: NULL and wordless texts have no words and no hits; items
without words match nothing, short items match as one window; repeated items
and items with a NULL id count (a NULL id as the empty string); repeated
document rows get the same answer; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import byte_list, clean_text, keyed, original_id, small_batches, stored
from shelfwise.llm.hashing import Rolling

WINDOW = 10
BROADCAST_WINDOWS = 1 << 20
#: Lower-cases A-Z, keeps a-z, 0-9 and all bytes of non-ASCII characters, blanks the rest.
_WORDS = bytes(b if b >= 0x80 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())


def words(text: bytes) -> bytes:
    """The normalised words of a text, joined by one blank."""
    return b" ".join(text.translate(_WORDS).split())


def _bounds(joined: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and stop of each word in texts that each end in a blank."""
    stop = np.flatnonzero(joined == 32)
    start = np.concatenate([[0], stop[:-1] + 1]) if len(stop) else stop
    return start, stop


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct ``gram`` (joined words) and ``n`` (its words) with the items that hold it."""
    def run(batches):
        for b in batches:
            items, grams, ns = [], [], []
            for item, text in zip(b.column("item").to_pylist(), byte_list(b.column("text"))):
                w = words(text).split()
                n = min(size, len(w))
                for i in range(len(w) - n + 1 if n else 0):
                    items.append(item)
                    grams.append(b" ".join(w[i:i + n]))
                    ns.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(grams, pa.binary()), pa.array(ns, pa.int32())], ["item", "gram", "n"])

    rows = benchmark.select(F.coalesce(benchmark[id_col].cast("string"), F.lit("")).alias("item"),
                            clean_text(benchmark[text_col]).alias("text"))
    return (rows.mapInArrow(run, "item string, gram binary, n int")
            .groupBy("gram", "n").agg(F.sort_array(F.collect_set("item")).alias("items")))


class WindowSet:
    """Lookup of windows by hash, per window length; built once per task from the broadcast rows."""

    def __init__(self, rows: list[tuple[bytes, int, list[str]]]):
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, list]] = {}
        sizes = defaultdict(list)
        for gram, n, items in rows:
            sizes[n].append((gram, items))
        for n, grams in sizes.items():
            buf = b"".join(g for g, _ in grams)
            stop = np.cumsum([len(g) for g, _ in grams])
            start = np.concatenate([[0], stop[:-1]])
            keys = Rolling(np.frombuffer(buf, np.uint8)).ranges(start, stop)
            order = np.argsort(keys, kind="stable")
            sieve = np.zeros(1 << 20, bool)
            sieve[(keys & np.uint64(0xFFFFF)).astype(np.int64)] = True
            self.by_size[n] = (keys[order], sieve, [grams[i] for i in order])

    def hits(self, roll: Rolling, start: np.ndarray, stop: np.ndarray, first: np.ndarray, data: bytes):
        """``(word index, size, items)`` of each verified window; ``first`` is each word's document's last word + 1."""
        for n, (keys, sieve, grams) in self.by_size.items():
            if len(start) < n:
                continue
            at = np.arange(len(start) - n + 1)
            at = at[at + n <= first[:len(at)]]
            found = roll.ranges(start[at], stop[at + n - 1])
            maybe = sieve[(found & np.uint64(0xFFFFF)).astype(np.int64)]
            at, found = at[maybe], found[maybe]
            lo, hi = np.searchsorted(keys, found, "left"), np.searchsorted(keys, found, "right")
            for k in np.flatnonzero(hi > lo):
                i = int(at[k])
                gram = data[start[i]:stop[i + n - 1]]
                for known, items in grams[lo[k]:hi[k]]:
                    if known == gram:
                        yield i, n, items


def _scan(docs: DataFrame, shared, *, flags: bool) -> DataFrame:
    """``ord, h, n_words, items`` and, with ``flags``, the hit words as a bit per word."""
    def run(batches):
        known = WindowSet(shared.value)
        for b in small_batches(batches, lean=True):
            joined = [words(t) for t in byte_list(b.column("text"))]
            data = b"".join(j + b" " if j else b"" for j in joined)
            buf = np.frombuffer(data, np.uint8)
            start, stop = _bounds(buf, None)
            counts = np.array([j.count(b" ") + 1 if j else 0 for j in joined])
            ends = np.cumsum(counts)
            delta = np.zeros(len(start) + 1, np.int64)
            items = [set() for _ in joined]
            for i, n, names in known.hits(Rolling(buf), start, stop, np.repeat(ends, counts), data):
                delta[i] += 1
                delta[i + n] -= 1
                items[int(np.searchsorted(ends, i, "right"))].update(names)
            hit = np.cumsum(delta[:-1]) > 0
            total = np.concatenate([[0], np.cumsum(hit)])
            begins = ends - counts
            bits = [np.packbits(hit[a:z]).tobytes() if s else b"" for a, z, s in zip(begins, ends, items)] if flags else [b""] * len(joined)
            yield pa.RecordBatch.from_arrays(
                [b.column("ord"), b.column("h"), pa.array(counts, pa.int64()), pa.array(total[ends] - total[begins], pa.int64()),
                 pa.array([sorted(s) for s in items], pa.list_(pa.string())), pa.array(bits, pa.binary())],
                ["ord", "h", "n_words", "n_hit", "items", "bits"])

    return docs.mapInArrow(run, "ord long, h long, n_words long, n_hit long, items array<string>, bits binary")


def _united(parts: list[DataFrame]) -> DataFrame:
    """Hits of several window blocks, per document row."""
    def merge(batches):
        for b in batches:
            out = [np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in bits if x], axis=0).tobytes() if any(bits) else b""
                   for bits in b.column("all_bits").to_pylist()]
            n = [int(np.unpackbits(np.frombuffer(x, np.uint8)).sum()) for x in out]
            yield pa.RecordBatch.from_arrays([b.column("ord"), b.column("h"), b.column("n_words"), pa.array(n, pa.int64()), b.column("items"), pa.array(out, pa.binary())],
                                             ["ord", "h", "n_words", "n_hit", "items", "bits"])

    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    keyed_rows = rows.groupBy("ord", "h").agg(
        F.max("n_words").alias("n_words"), F.collect_list("bits").alias("all_bits"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    whole = keyed_rows.mapInArrow(merge, "ord long, h long, n_words long, n_hit long, items array<string>, bits binary")
    return parts[0].select("ord", "h").join(whole, ["ord", "h"])


def find_contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, *, flags: bool = False,
                       bound: int = BROADCAST_WINDOWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: ``ord, h, n_words, n_hit, items, bits``."""
    spark = docs.sparkSession
    windows = stored(benchmark_windows(benchmark, size), "windows")
    count = windows.count()
    rows = keyed(docs, id_col, text_col)
    blocks = -(-count // bound) or 1
    parts = []
    for k in range(blocks):
        block = windows if blocks == 1 else windows.where(F.pmod(F.xxhash64("gram"), F.lit(blocks)) == k)
        shared = spark.sparkContext.broadcast([(bytes(r[0]), r[1], r[2]) for r in block.collect()])
        parts.append(_scan(rows, shared, flags=flags or blocks > 1))
    return parts[0] if blocks == 1 else _united(parts)


def as_contract(found: DataFrame) -> DataFrame:
    return found.select(
        original_id().alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def without_spans(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``ord, h, text`` with the hit words cut out of the original text, for rows that have hits (``flags=True``)."""
    hit = found.where("n_hit > 0").select("ord", "h", "bits").dropDuplicates(["ord", "h"])

    def run(batches):
        for b in batches:
            out = []
            for text, bits in zip(byte_list(b.column("text")), b.column("bits").to_pylist()):
                plain = np.frombuffer(text.translate(_WORDS), np.uint8) != 32
                first = np.flatnonzero(plain & ~np.concatenate([[False], plain[:-1]]))
                gone = np.unpackbits(np.frombuffer(bits, np.uint8))[:len(first)].astype(bool)
                word = np.cumsum(np.isin(np.arange(len(plain)), first)) - 1
                drop = (word >= 0) & plain & gone[np.maximum(word, 0)]
                # what stands between two dropped words goes too
                drop |= (word >= 0) & ~plain & gone[np.maximum(word, 0)] & np.append(gone, False)[np.maximum(word, 0) + 1]
                out.append(np.frombuffer(text, np.uint8)[~drop].tobytes().decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays([b.column("ord"), b.column("h"), pa.array(out, pa.string())], ["ord", "h", "text"])

    return keyed(docs, id_col, text_col).join(hit, ["ord", "h"]).mapInArrow(run, "ord long, h long, text string")
