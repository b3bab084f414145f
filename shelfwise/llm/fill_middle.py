"""Fill-in-the-middle: cut each text at two line ends and reorder the three pieces.

Content-defined chunk memoization. Texts are cut into chunks where a rolling hash
of the last 32 bytes says so (512 bytes at least, 16 KB at most), so that
texts that share passages share chunks. A chunk's summary, its line ends with the
code points before each, and its code points in all, is computed once a task
and kept in a cache by the chunk's hash; a chunk found there must equal the cached
bytes. Running sums over the summaries of a text's chunks say how many lines and
code points stand before each chunk: a cut after line k is looked up in the
sums, then in one chunk. The cache holds a fixed number of bytes, the oldest go first.

Everything happens in the scan stage: no shuffle, nothing is kept between tasks.
What is random comes from SHA-256 of the salt and the id, so a lost task gives the
same rows again.

Nulls and edge cases. A NULL text counts as empty; empty texts, and texts that hold
a sentinel, stay ``plain``. A NULL id takes part as the empty string. Rows that share
an id get the same draws; repeated rows the same result. An empty table gives no
rows. Other columns, whatever their names, are ignored. A text is handled whole,
some fifteen times its size in memory.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import batch_of, clean_text, small_batches, texts
from shelfwise.llm.hashing import Rolling

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SALT = 7
RATE, SPM_RATE = 100, 50
WINDOW, LEAST, MOST, MASK = 32, 512, 1 << 14, np.uint64((1 << 11) - 1)
CACHE_BYTES = 16 << 20
#: Text bytes whose rolling hashes a task holds at once.
PIECE_BYTES = 1 << 18
SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                    ("middle_chars", pa.int64()), ("output", pa.large_string())])


class Summary:
    """Of a chunk: ``ends``, the offsets after its line ends, ``points``, the code points before each, and ``chars`` in all."""

    __slots__ = ("body", "chars", "ends", "points")

    def __init__(self, body: bytes):
        data = np.frombuffer(body, np.uint8)
        starts = np.cumsum((data & 0xC0) != 0x80, dtype=np.int32)
        self.body = body
        self.ends = np.flatnonzero(data == 10).astype(np.int32) + 1
        self.points = starts[self.ends - 1]
        self.chars = int(starts[-1]) if len(data) else 0


class Cache:
    """Summaries by chunk hash, checked against the chunk's bytes; bounded by the bytes it holds."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit, self.held, self.hits, self.misses = limit, 0, 0, 0
        self.known: OrderedDict[int, Summary] = OrderedDict()

    def summary(self, key: int, body: bytes) -> Summary:
        found = self.known.get(key)
        if found is not None and found.body == body:
            self.hits += 1
            self.known.move_to_end(key)
            return found
        self.misses += 1
        made = Summary(body)
        if found is None:
            self.known[key] = made
            self.held += self._size(made)
            while self.held > self.limit:
                self.held -= self._size(self.known.popitem(last=False)[1])
        return made

    @staticmethod
    def _size(s: Summary) -> int:
        return 500 + len(s.body) + 8 * len(s.ends)


def chunk_ends(marks: np.ndarray, start: int, stop: int) -> list[int]:
    """Ends of the chunks of ``start..stop``: the first mark at least ``LEAST`` on, at most ``MOST`` on."""
    out, at = [], start
    while at < stop:
        k = int(np.searchsorted(marks, at + LEAST))
        at = min(int(marks[k]) if k < len(marks) else stop, at + MOST, stop)
        out.append(at)
    return out


class Text:
    """The chunks of one text with running counts of their lines and code points."""

    def __init__(self, bounds: list[int], summaries: list[Summary]):
        self.bounds, self.summaries = bounds, summaries
        self.lines = np.cumsum([0] + [len(s.ends) for s in summaries])
        self.chars = np.cumsum([0] + [s.chars for s in summaries])
        tail = summaries and (not len(summaries[-1].ends) or summaries[-1].ends[-1] < len(summaries[-1].body))
        self.n = int(self.lines[-1]) + bool(tail)

    def cut(self, k: int) -> tuple[int, int]:
        """Byte offset (as the bounds count) and code points after line ``k``."""
        if k == 0:
            return self.bounds[0], 0
        if k > self.lines[-1]:
            return self.bounds[-1], int(self.chars[-1])
        c = int(np.searchsorted(self.lines, k)) - 1
        j = k - int(self.lines[c]) - 1
        s = self.summaries[c]
        return self.bounds[c] + int(s.ends[j]), int(self.chars[c]) + int(s.points[j])


def draws(salt: int, doc_id: int | None) -> tuple[int, int, int, int]:
    """Four 32-bit numbers from the salt and the decimal id."""
    digest = hashlib.sha256(f"{salt}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int(x) for x in np.frombuffer(digest[:16], ">u4"))


def transform(batches: Iterable[pa.RecordBatch], cache: Cache, salt: int, rate: int, spm_rate: int) -> Iterator[pa.RecordBatch]:
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    for batch in small_batches(batches, limit=PIECE_BYTES):
        off, data = texts(batch.column("text"))
        raw = data[off[0]:off[-1]]
        off = off - off[0]
        body = raw.tobytes()
        rolling = Rolling(raw)
        marks = np.flatnonzero(rolling.grams(WINDOW) & MASK == 0) + WINDOW
        ids = batch.column("doc_id").to_pylist()
        rows = []
        for i, doc_id in enumerate(ids):
            lo, hi = int(off[i]), int(off[i + 1])
            ends = chunk_ends(marks, lo, hi)
            bounds = np.array([lo, *ends], np.int64)
            keys = rolling.ranges(bounds[:-1], bounds[1:]).tolist()
            text = Text(bounds.tolist(), [cache.summary(key, body[a:b]) for key, a, b in zip(keys, bounds, bounds[1:])])
            h1, h2, h3, h4 = draws(salt, doc_id)
            whole = body[lo:hi]
            if not whole or p in whole or s in whole or m in whole or h3 % 100 >= rate:
                rows.append((doc_id, text.n, "plain", None, None, whole.decode()))
                continue
            first, second = sorted((h1 % (text.n + 1), h2 % (text.n + 1)))
            (a, before), (b, until) = text.cut(first), text.cut(second)
            prefix, middle, suffix = body[lo:a], body[a:b], body[b:hi]
            spm = h4 % 100 < spm_rate
            out = s + suffix + p + prefix + m + middle if spm else p + prefix + s + suffix + m + middle
            rows.append((doc_id, text.n, "spm" if spm else "psm", before, until - before, out.decode()))
        yield batch_of(_ARROW, list(zip(*rows)))


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salt: int = SALT, rate: int = RATE,
                   spm_rate: int = SPM_RATE, cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """A row per document row: ``doc_id, n`` (its lines), ``form``, ``prefix_chars, middle_chars`` (code points, NULL if plain), ``output``.

    ``rate`` percent of the texts are reordered, ``spm_rate`` percent of those suffix first.
    """
    src = docs.select(docs[id_col].cast("long").alias("doc_id"), clean_text(docs[text_col]).alias("text"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from transform(batches, Cache(cache_bytes), salt, rate, spm_rate)

    return src.mapInArrow(apply, SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from; a reordered text holds no sentinel, so each stands there once.

    The pieces are cut out by searches in the bytes, which copy a piece and nothing else.
    """
    middle, head = F.substring_index(output, MIDDLE, -1), F.substring_index(output, MIDDLE, 1)

    def opening(mark: str) -> Column:  # between the sentinel at the start and ``mark``
        return F.substring_index(output, mark, 1).substr(F.lit(len(PREFIX) + 1), F.octet_length(output))

    psm = F.concat(opening(SUFFIX), middle, F.substring_index(head, SUFFIX, -1))
    spm = F.concat(F.substring_index(head, PREFIX, -1), middle, opening(PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def as_contract(made: DataFrame) -> DataFrame:
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
