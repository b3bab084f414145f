"""Helpers shared by the text operators: stored intermediates, Arrow views, row keys.

Row keys. A document row is named inside the operators by ``(ord, h)``: ``ord``
is its id (a NULL id sorts after all others: the largest long), ``h`` a 64-bit
hash of its text, as a signed long. Rows that share both are repeats of one another and get the
same answer.
"""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NULL_ORD = (1 << 63) - 1
#: Text bytes handled at once inside a task (a longer single text is handled alone).
SLICE_BYTES = 1 << 20


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; a temporary one only in local mode."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="shelfwise-llm-")
    return f"{base.rstrip('/')}/shelfwise-llm-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back (cuts the lineage)."""
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, made longer until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def clean_text(text: Column) -> Column:
    """NULL counts as the empty text."""
    return F.coalesce(text.cast("string"), F.lit(""))


def text_hash(text: Column) -> Column:
    return F.xxhash64(clean_text(text))


def ordinal(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(NULL_ORD))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``ord, h, text`` of each row, whatever other columns the input has."""
    return docs.select(
        ordinal(docs[id_col]).alias("ord"),
        text_hash(docs[text_col]).alias("h"),
        clean_text(docs[text_col]).alias("text"),
    )


def original_id(ord_col: str = "ord") -> Column:
    return F.when(F.col(ord_col) != NULL_ORD, F.col(ord_col)).cast("long")


def apply_decisions(docs: DataFrame, decisions: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``decisions (ord, h, keep)`` drops, columns unchanged.

    ``decisions`` has a row per document row. Of rows that repeat one another as
    many stay as are marked to be kept: all of them, or one. Only the keys that
    lose rows are joined, so a table that loses little moves little.
    """
    o, h = free_name(docs, "_ord"), free_name(docs, "_h")
    marked = docs.withColumns({o: ordinal(docs[id_col]), h: text_hash(docs[text_col])})
    columns = [f"`{c}`" for c in docs.columns]
    keys = stored(decisions.groupBy(F.col("ord").alias(o), F.col("h").alias(h))
                  .agg(F.count("*").alias("n"), F.sum(F.col("keep").cast("int")).alias("kept")).where("kept < n"), "keys")
    out = marked.join(keys.select(o, h), [o, h], "left_anti").select(*columns)
    repeated = keys.where("kept > 0").select(o, h)
    if repeated.isEmpty():
        return out
    return out.unionByName(marked.join(repeated, [o, h], "left_semi").dropDuplicates([o, h]).select(*columns))


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(offsets, bytes)`` of a string or binary column without NULLs."""
    arr = column.cast(pa.large_binary())
    _, offsets, data = arr.buffers()
    off = np.frombuffer(offsets, np.int64)[arr.offset:arr.offset + len(arr) + 1]
    return off, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (one row at least)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def lean_memory() -> None:
    """In a task: let the Python worker give arrays of 1 MB and more back to the system when they are freed (glibc keeps
    them by a threshold that grows with use); workers live as long as their executor."""
    if not TaskContext.get():
        return
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD


def small_batches(batches: Iterable[pa.RecordBatch], text: str = "text", lean: bool = False,
                  limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of text; ``lean``, where memory is scarcer than time, calls ``lean_memory``."""
    if lean:
        lean_memory()
    for batch in batches:
        if batch.num_rows:
            off, _ = texts(batch.column(text))
            for lo, hi in slices(off, limit):
                yield batch.slice(lo, hi - lo)


def byte_list(column: pa.Array) -> list[bytes]:
    return column.cast(pa.large_binary()).to_pylist()


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
