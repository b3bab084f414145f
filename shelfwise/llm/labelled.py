"""A bounded sample of labelled documents for fitting a classifier on the driver."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import clean_text, stored
from shelfwise.llm.hashing import mix

#: At most so many rows of each label are fetched for fitting, of at most so many characters each where there are such,
#: else the shortest whole texts, one at least, of at most so many characters together.
ROWS_PER_LABEL = 1500
MAX_CHARS = 6_000
LONG_CHARS = 1_000_000


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether the crc32 of the id as text leaves that remainder; a NULL id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)) == part, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, parts: int, part: int,
           rows_per_label: int = ROWS_PER_LABEL, max_chars: int = MAX_CHARS) -> tuple[list[bytes], np.ndarray, float]:
    """Texts and 0/1 labels of rows that aren't held out: of each label the first by hash of the id that
    have a text of at most ``max_chars``; and the log odds of label 1 among all such rows.

    A label all of whose texts are longer is learned from the shortest of them. Near copies say nothing new, so one of them stays.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
             .where("doc_id IS NOT NULL AND y IN (0, 1)").where(~held_out(F.col("doc_id"), parts, part))
             .groupBy("doc_id").agg(F.max("y").alias("y")))
    body = docs.select(docs["doc_id"].cast("long").alias("doc_id"), clean_text(docs["text"]).alias("text"))
    body = body.withColumns({"h": F.xxhash64("text"), "size": F.length("text")})
    # Places of the sample go to distinct texts that can be used; texts themselves are fetched by a broadcast of the chosen.
    able = stored(body.select("doc_id", "h", "size").join(known, "doc_id").distinct(), "labelled")
    shortest = {r[0]: r[1] for r in able.groupBy("y").agg(F.min("size")).collect()}
    texts, ys = [], []
    for y in (0, 1):
        of_label = able.where(F.col("y") == y)
        if shortest.get(y, 0) <= max_chars:
            chosen = of_label.where(F.col("size") <= max_chars).orderBy(F.xxhash64("doc_id"), "doc_id", "h").limit(rows_per_label)
        else:
            first = of_label.orderBy("size", "doc_id", "h").limit(rows_per_label)
            so_far = F.sum("size").over(Window.orderBy("size", "doc_id", "h"))
            chosen = first.withColumn("sum", so_far).where((F.col("sum") <= LONG_CHARS) | (F.col("sum") == F.col("size")))
        chosen = chosen.select("doc_id", "h")
        rows = body.join(F.broadcast(chosen), ["doc_id", "h"]).dropDuplicates(["doc_id", "h"]).select("doc_id", "text")
        seen = set()
        for _, text in sorted((r[0], r[1]) for r in rows.collect()):
            marks = _marks(text.encode())
            if seen.isdisjoint(marks):
                texts.append(text.encode())
                ys.append(y)
            seen.update(marks)
    count = {r[0]: r[1] for r in known.groupBy("y").count().collect()}
    return texts, np.array(ys, np.int64), float(np.log((count.get(1, 0) + 0.5) / (count.get(0, 0) + 0.5)))


def _marks(text: bytes, bands: int = 4, band: int = 3) -> list[tuple]:
    """Smallest hashes of the word couples, in bands; near copies share a band."""
    w = text.lower().split()
    couples = np.array(sorted({zlib.crc32(a + b" " + b) for a, b in zip(w, w[1:] or [b""])}) or [0], np.uint64)
    low = [int(mix(couples + np.uint64(i << 40)).min()) for i in range(bands * band)]
    return [(k, *low[k * band:(k + 1) * band]) for k in range(bands)]


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 200, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic regression (last one: intercept), labels weighted as they are, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(min(steps, 50)):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w
