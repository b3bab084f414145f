"""Records of delimited text files that may hold quoted newlines, read in splits.

A record can end only where no quoted field is open, and whether one is open at a
split's start depends on everything before. Each line maps "outside" and "inside a
quoted field" to the state after it; such maps compose, so a split of a file is
summed up by where it leads from either state:

1. a first pass over the lines gives a row per split: its number of lines, the
   state after it from either start, and whether a record open at its start ends in it;
2. running composition over a file's splits (a window over that small table)
   gives each split its starting state and the number of its first line;
3. a second pass, which meets the table by a broadcast, cuts records inside its
   split. The table has one row a split, no more than the driver's own list of splits.
   A record that goes on in other splits leaves as pieces, which are put together
   by a grouping. Without such records that branch reads nothing: its
   side of the join is empty and adaptive execution drops it.

No line is shuffled or sorted, and nothing is stored. Lines end with ``\\n`` or
``\\r\\n``. Fields are cut as the original's reader does: a quote opens a quoted field
only where the field begins, a doubled quote inside is a quote, and what follows the
closing quote up to the separator belongs to the field. Blank lines are skipped, but
counted. A quoted field that never ends is an error with its file and line.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_BODY = re.compile(r'[^"]*(?:""[^"]*)*')
_FACTS = "fid bigint, block bigint, lines bigint, out_after int, in_after int, ends boolean"
_CUT = "fields array<string>, file string, line bigint, block bigint, owner bigint"
_FACTS_ARROW = pa.schema([("fid", pa.int64()), ("block", pa.int64()), ("lines", pa.int64()), ("out_after", pa.int32()),
                          ("in_after", pa.int32()), ("ends", pa.bool_())])
_CUT_ARROW = pa.schema([("fields", pa.list_(pa.string())), ("file", pa.string()), ("line", pa.int64()), ("block", pa.int64()),
                        ("owner", pa.int64())])


def closing(text: str, start: int) -> int:
    """Place after the quote that closes the field open at ``start``; -1 if none does."""
    end = _BODY.match(text, start).end()
    return end + 1 if end < len(text) else -1


def state_after(line: str, inside: bool, sep: str = "\t") -> bool:
    """Whether a quoted field is open after ``line``."""
    at = 0
    if inside:
        at = closing(line, 0)
        if at < 0:
            return True
        at = line.find(sep, at) + 1
        if not at:
            return False
    while True:
        if line.startswith('"', at):
            at = closing(line, at + 1)
            if at < 0:
                return True
        at = line.find(sep, at) + 1
        if not at:
            return False


def split_fields(record: str, sep: str = "\t") -> list[str] | None:
    """The fields of a record; None if a quoted one never ends."""
    out, at = [], 0
    while True:
        value = ""
        if record.startswith('"', at):
            end = closing(record, at + 1)
            if end < 0:
                return None
            value = record[at + 1:end - 1].replace('""', '"')
            at = end
        end = record.find(sep, at)
        if end < 0:
            return [*out, value + record[at:]]
        out.append(value + record[at:end])
        at = end + 1


def _runs(batch: pa.RecordBatch, *keys: str) -> Iterator[tuple[int, int]]:
    """Row ranges of equal keys."""
    change = np.zeros(batch.num_rows, bool)
    if len(change):
        change[0] = True
    for key in keys:
        column = batch.column(key)
        if batch.num_rows > 1:
            change[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(change).tolist()
    yield from zip(at, [*at[1:], batch.num_rows])


def _quoted(values: pa.Array) -> list[int]:
    return np.flatnonzero(pc.match_substring(values, '"').to_numpy(zero_copy_only=False)).tolist()


def _facts(batches: Iterable[pa.RecordBatch], sep: str) -> Iterator[pa.RecordBatch]:
    """One row per split; a split is never spread over tasks."""
    held = None
    for batch in batches:
        for lo, hi in _runs(batch, "fid", "block"):
            key = (batch.column("fid")[lo].as_py(), batch.column("block")[lo].as_py())
            if held is None or held[0] != key:
                if held is not None:
                    yield _facts_row(held)
                held = [key, 0, False, True, False]
            values = batch.column("value").slice(lo, hi - lo)
            held[1] += hi - lo
            for i in _quoted(values):
                line = values[i].as_py()
                held[2] = state_after(line, held[2], sep)
                held[3] = state_after(line, held[3], sep)
                held[4] |= not held[3]
    if held is not None:
        yield _facts_row(held)


def _facts_row(held: list) -> pa.RecordBatch:
    (fid, block), lines, out_after, in_after, ends = held
    return pa.RecordBatch.from_pylist([{"fid": fid, "block": block, "lines": lines, "out_after": int(out_after),
                                        "in_after": int(in_after), "ends": bool(ends)}], _FACTS_ARROW)


class _Split:
    """Cuts the lines of one split, which come in several batches, into records."""

    def __init__(self, file: str, block: int, line: int, inside: bool, owner: int | None, sep: str):
        self.file, self.block, self.line, self.inside, self.owner, self.sep = file, block, line, inside, owner, sep
        self.open: list[str] = []
        self.open_line = line
        self.leading = inside

    def _record(self, text: str, line: int) -> tuple:
        fields = split_fields(text.removesuffix("\r"), self.sep)
        if fields is None:
            raise ValueError(f"quote without end in {self.file}, line {line}")
        return fields, self.file, line, self.block, None

    def _piece(self, owner: int | None) -> tuple:
        return ["\n".join(self.open)], self.file, None if self.leading else self.open_line, self.block, owner

    def lines(self, values: pa.Array) -> Iterator[pa.RecordBatch]:
        special = _quoted(values)
        at = 0
        for i in [*special, len(values)]:
            if i > at:
                plain = values.slice(at, i - at)
                if self.inside:
                    self.open.extend(plain.to_pylist())
                else:
                    yield self._plain(plain)
                self.line += i - at
            if i < len(values):
                yield from self._special(values[i].as_py())
                self.line += 1
            at = i + 1

    def _special(self, text: str) -> Iterator[pa.RecordBatch]:
        was = self.inside
        self.inside = state_after(text, was, self.sep)
        if not was:
            self.open, self.open_line, self.leading = [], self.line, False
        self.open.append(text)
        if not self.inside:
            row = self._piece(self.owner) if self.leading else self._record("\n".join(self.open), self.open_line)
            self.open, self.leading = [], False
            yield _cut([row])

    def _plain(self, values: pa.Array) -> pa.RecordBatch:
        """Lines without a quote, outside of quoted fields: a record each."""
        numbers = np.arange(self.line, self.line + len(values))
        real = pc.not_equal(pc.utf8_trim(values, characters=" \r"), "")
        values, numbers = values.filter(real), pa.array(numbers, pa.int64()).filter(real)
        if pc.any(pc.ends_with(values, "\r")).as_py():
            values = pc.replace_substring_regex(values, r"\r$", "")
        n = len(values)
        return pa.RecordBatch.from_arrays(
            [pc.split_pattern(values, self.sep).cast(_CUT_ARROW.field("fields").type), pa.array([self.file] * n, pa.string()), numbers,
             pa.array(np.full(n, self.block), pa.int64()), pa.nulls(n, pa.int64())], schema=_CUT_ARROW)

    def rest(self) -> Iterator[pa.RecordBatch]:
        """What is open at the split's end: the front of a record that goes on, or the middle of one from before."""
        if self.inside:
            yield _cut([self._piece(self.owner if self.leading else self.block)])


def _cut(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), _CUT_ARROW)], schema=_CUT_ARROW)


def _records(batches: Iterable[pa.RecordBatch], sep: str) -> Iterator[pa.RecordBatch]:
    split = None
    for batch in batches:
        for lo, hi in _runs(batch, "file", "block"):
            first = {c: batch.column(c)[lo].as_py() for c in ("file", "block", "line", "inside", "owner")}
            if split is None or (split.file, split.block) != (first["file"], first["block"]):
                if split is not None:
                    yield from split.rest()
                split = _Split(first["file"], first["block"], first["line"], bool(first["inside"]), first["owner"], sep)
            yield from split.lines(batch.column("value").slice(lo, hi - lo))
    if split is not None:
        yield from split.rest()


def _whole(batches: Iterable[pa.RecordBatch], sep: str) -> Iterator[pa.RecordBatch]:
    """Records put together from their pieces."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            fields = split_fields(r["text"].removesuffix("\r"), sep)
            if fields is None:
                raise ValueError(f"quote without end in {r['file']}, line {r['line']}")
            rows.append((fields, r["file"], r["line"], r["block"], None))
        if rows:
            yield _cut(rows)


def split_table(raw: DataFrame, sep: str = "\t") -> DataFrame:
    """``fid, block, line, inside, owner`` of each split: number of its first line, whether it starts inside a quoted
    field, and the split in which that field's record began."""
    facts = raw.select("fid", "block", "value").mapInArrow(lambda batches: _facts(batches, sep), _FACTS)
    file = Window.partitionBy("fid").orderBy("block")
    so_far, before = file.rowsBetween(Window.unboundedPreceding, 0), file.rowsBetween(Window.unboundedPreceding, -1)
    # A split that leads to the same state from either start fixes it; between such splits only toggles count.
    toggles = F.sum(((F.col("out_after") == 1) & (F.col("in_after") == 0)).cast("int")).over(so_far) % 2
    fixed = F.when(F.col("out_after") == F.col("in_after"), (F.col("out_after") + F.col("toggles")) % 2)
    facts = facts.withColumn("toggles", toggles)
    facts = facts.withColumn("after", (F.coalesce(F.last(fixed, ignorenulls=True).over(so_far), F.lit(0)) + F.col("toggles")) % 2)
    facts = facts.withColumn("inside", F.coalesce(F.lag("after").over(file), F.lit(0)))
    begins = (F.col("after") == 1) & ((F.col("inside") == 0) | F.col("ends"))
    return facts.select("fid", "block", (F.coalesce(F.sum("lines").over(before), F.lit(0)) + 1).alias("line"), "inside",
                        F.last(F.when(begins, F.col("block")), ignorenulls=True).over(before).alias("owner"), "after")


def read_records(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """``fields array<string>, file, line``: every record of the files, with the number of its first line in its file, from 1."""
    raw = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    raw = raw.withColumn("fid", F.xxhash64("file"))
    splits = split_table(raw, sep)

    def cut(of: DataFrame) -> DataFrame:
        rows = raw.join(F.broadcast(of), ["fid", "block"]).select("value", "file", "block", "line", "inside", "owner")
        return rows.mapInArrow(lambda batches: _records(batches, sep), _CUT)

    pieces = cut(splits.where("inside = 1 OR after = 1").drop("after")).where("owner IS NOT NULL")
    together = pieces.groupBy("file", "owner").agg(
        F.array_sort(F.collect_list(F.struct("block", "line", F.get("fields", F.lit(0)).alias("text")))).alias("p")).select(
        F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text"), "file", F.get("p", F.lit(0))["line"].alias("line"),
        F.col("owner").alias("block"))
    spanning = together.mapInArrow(lambda batches: _whole(batches, sep), _CUT)
    inside = cut(splits.drop("after")).where("owner IS NULL")
    return inside.unionByName(spanning).select("fields", "file", "line")
