"""Repeated windows over a corpus by winnowed anchors: the frame of two operators.

A window is ``length`` consecutive units (words or bytes) of one document. The
smallest ``seed``-unit gram in it is its anchor, so equal windows have equal
anchors wherever they stand, and neighbouring windows mostly share one: an
anchor owns a run of windows, whose text is the anchor's context.

1. Each scan task finds its anchors. A context that an earlier document (or,
   with ``within``, an earlier place of the same one) of the same task also has
   is settled there; per context one row leaves the task.
2. Rows meet by anchor. Equal contexts are settled by the earliest of them.
   Anchors with several contexts are open: their windows may repeat in part.
   An anchor with many contexts in one task is marked hot; its rows meet by
   context instead, so no task gathers them.
3. Open contexts are fetched from their documents and resolved: up to
   ``group_limit`` rows of an anchor by the operator's own method, the
   others window by window, by hash of the window and its anchor.

Every step answers with ranges of repeated windows per document. "Earlier" is
the order of ``(ord, h)``, then the place; documents that share an id are
ordered by their text's hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import byte_list, keyed, partitions, small_batches, stored
from shelfwise.llm.hashing import PrimeRolling, Rolling, mix, window_owners

#: Rows a scan task holds before it sends them on.
FLUSH_ROWS = 400_000
#: Contexts of one anchor in one task from which on the anchor is hot.
HOT_CONTEXTS = 32
#: A partition works route by route, so it holds so small a part of its rows at once. A task sends a row per route.
ROUTES_PER_PARTITION = 2
ROUTED = "route int, kind int, ord long, h long, data binary"
SETTLED, BY_ANCHOR, BY_CONTEXT, OPEN = range(4)

ANCHOR = np.dtype([("a", "<u8"), ("c", "<u8"), ("ord", "<i8"), ("h", "<i8"), ("at", "<u4"), ("off", "u1"), ("n", "u1")])
OPENED = np.dtype([("a", "<u8"), ("at", "<u4"), ("off", "u1"), ("n", "u1"), ("hot", "u1")])
RANGE = np.dtype([("at", "<u4"), ("n", "<u4")])


@dataclass(frozen=True)
class Rule:
    words: bool
    length: int
    seed: int
    within: bool
    group_limit: int
    #: Context rows (dtype ``context_type``) of whole anchor groups -> mask and ranges of repeated windows.
    resolve: Callable
    context_type: Callable

    @property
    def width(self) -> int:
        return self.length - self.seed + 1


class View:
    """Units of some texts one after the other; ``first`` is each text's first unit, and the end."""

    def __init__(self, texts: list[bytes], words: bool):
        if words:
            texts = [b" ".join(t.split()) for t in texts]
            self.data = np.frombuffer(b"".join(t + b" " if t else b"" for t in texts), np.uint8)
            self.stop = np.flatnonzero(self.data == 32)
            self.start = np.concatenate([[0], self.stop[:-1] + 1]) if len(self.stop) else self.stop
            sizes = [t.count(b" ") + 1 if t else 0 for t in texts]
        else:
            self.data = np.frombuffer(b"".join(texts), np.uint8)
            self.start = self.stop = None
            sizes = [len(t) for t in texts]
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.roll = Rolling(self.data)  # finds anchors
        self.strong = PrimeRolling(self.data)  # tells contexts and windows apart

    def hashes(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Hash of units ``lo`` to before ``hi``."""
        return self.strong.ranges(lo, hi) if self.start is None else self.strong.ranges(self.start[lo], self.stop[hi - 1])

    def grams(self, k: int) -> np.ndarray:
        if self.start is None:
            return self.roll.grams(k)
        n = max(len(self.start) - k + 1, 0)
        return self.roll.ranges(self.start[:n], self.stop[k - 1:k - 1 + n])


def spread(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """All numbers of the ranges ``lo, lo + 1, ... lo + n - 1``, one range after the other."""
    before = np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else n
    return np.repeat(lo - before, n) + np.arange(int(n.sum()))


def anchors(view: View, rule: Rule, ords: np.ndarray, hs: np.ndarray) -> np.ndarray:
    grams = view.grams(rule.seed)
    owner = window_owners(grams, rule.width)
    windows = np.maximum(np.diff(view.first) - rule.length + 1, 0)
    s = spread(view.first[:-1], windows)
    if not len(s):
        return np.zeros(0, ANCHOR)
    own = owner[s]
    new = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (s[1:] != s[:-1] + 1)]))
    lo, hi = s[new], s[np.concatenate([new[1:], [len(s)]]) - 1]
    doc = np.searchsorted(view.first, lo, "right") - 1
    out = np.empty(len(new), ANCHOR)
    out["a"], out["off"], out["n"] = grams[own[new]], own[new] - lo, hi - lo + 1
    out["c"] = mix(view.hashes(lo, hi + rule.length) + out["off"].astype(np.uint64))
    out["ord"], out["h"], out["at"] = ords[doc], hs[doc], lo - view.first[doc]
    return out


def settle(rows: np.ndarray, within: bool) -> tuple[np.ndarray, np.ndarray]:
    """``(repeated, rest)`` of rows with equal ``(a, c)``: repeated ones have an earlier equal among ``rows``."""
    rows = rows[np.lexsort((rows["at"], rows["h"], rows["ord"], rows["c"], rows["a"]))]
    if not len(rows):
        return rows, rows
    same = (rows["a"][1:] == rows["a"][:-1]) & (rows["c"][1:] == rows["c"][:-1])
    head = np.flatnonzero(np.concatenate([[True], ~same]))
    lead = np.repeat(head, np.diff(np.concatenate([head, [len(rows)]])))
    own = (rows["ord"] == rows["ord"][lead]) & (rows["h"] == rows["h"][lead])
    later = ~own | (rows["at"] != rows["at"][lead]) if within else ~own
    twice = np.concatenate([[False], same & own[1:] & own[:-1] & (rows["at"][1:] == rows["at"][:-1])])  # repeated document rows
    return rows[later & ~twice], rows[~later & ~twice]


def pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[], [], [], [], []]
    types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["route", "kind", "ord", "h", "data"])


def _by_document(rows: np.ndarray, kind: int, routes: int, fields: np.dtype) -> list[tuple]:
    """One row per document with the packed ``fields`` of its rows."""
    if not len(rows):
        return []
    rows = rows[np.lexsort((rows["at"], rows["h"], rows["ord"]))]
    cut = np.flatnonzero((rows["ord"][1:] != rows["ord"][:-1]) | (rows["h"][1:] != rows["h"][:-1])) + 1
    slim = np.empty(len(rows), fields)
    for name in fields.names:
        slim[name] = rows[name]
    if fields is RANGE:  # neighbouring ranges are one
        joins = np.concatenate([[False], slim["at"][1:] == slim["at"][:-1] + slim["n"][:-1]])
        joins[cut] = False
        head = np.flatnonzero(~joins)
        total = np.add.reduceat(slim["n"], head)
        slim, cut = slim[head], np.searchsorted(head, cut)
        slim["n"], rows = total, rows[head]
    begin = np.concatenate([[0], cut])
    ends = np.concatenate([cut, [len(slim)]])
    return [(_document_route(o, h, routes), kind, o, h, slim[x:y].tobytes())
            for x, y, o, h in zip(begin.tolist(), ends.tolist(), rows["ord"][begin].tolist(), rows["h"][begin].tolist())]


def _document_route(o: int, h: int, routes: int) -> int:
    """Rows that share an id (all that have none, say) go to different routes, ids in steps as well."""
    return int(mix(np.array([(o * 0x9E3779B97F4A7C15 + h) & 0xFFFFFFFFFFFFFFFF], np.uint64))[0]) % routes


def _by_route(rows: np.ndarray, key: np.ndarray, kind: int, routes: int) -> list[tuple]:
    """One packed row per route; the route follows from ``key``."""
    if not len(rows):
        return []
    route = (key % np.uint64(routes)).astype(np.int64)
    order = np.argsort(route, kind="stable")
    rows, route = rows[order], route[order]
    begin = np.concatenate([[0], np.flatnonzero(route[1:] != route[:-1]) + 1, [len(rows)]])
    return [(int(route[x]), kind, None, None, pack(rows[x:y].tobytes())) for x, y in zip(begin[:-1].tolist(), begin[1:].tolist())]


def _contexts_per_anchor(rows: np.ndarray) -> np.ndarray:
    """For rows ordered by anchor and context: how many contexts the row's anchor has."""
    if not len(rows):
        return np.zeros(0, np.int64)
    new_a = np.concatenate([[True], rows["a"][1:] != rows["a"][:-1]])
    new_c = new_a | np.concatenate([[True], rows["c"][1:] != rows["c"][:-1]])
    head = np.flatnonzero(new_a)
    return np.repeat(np.add.reduceat(new_c.astype(np.int64), head), np.diff(np.concatenate([head, [len(rows)]])))


def _rows_per_anchor(rows: np.ndarray) -> np.ndarray:
    """For rows ordered by anchor: how many rows the row's anchor has."""
    head = np.flatnonzero(np.concatenate([[True], rows["a"][1:] != rows["a"][:-1]])) if len(rows) else np.zeros(0, np.int64)
    size = np.diff(np.concatenate([head, [len(rows)]]))
    return np.repeat(size, size) if len(rows) else np.zeros(0, np.int64)


def _find(rule: Rule, routes: int):
    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        repeated, rest = settle(np.concatenate(held), rule.within)
        hot = _contexts_per_anchor(rest) >= HOT_CONTEXTS
        marks = np.zeros(len(np.unique(rest["a"][hot])), ANCHOR)
        marks["a"] = np.unique(rest["a"][hot])  # n = 0: the anchor is hot
        cold = np.concatenate([rest[~hot], marks])
        return _batch(_by_document(repeated, SETTLED, routes, RANGE) + _by_route(cold, cold["a"], BY_ANCHOR, routes)
                      + _by_route(rest[hot], mix(rest["a"][hot] ^ rest["c"][hot]), BY_CONTEXT, routes))

    def run(batches):
        held, size = [], 0
        for b in small_batches(batches):
            view = View(byte_list(b.column("text")), rule.words)
            found = anchors(view, rule, b.column("ord").to_numpy(), b.column("h").to_numpy())
            held.append(found)
            size += len(found)
            if size >= FLUSH_ROWS:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    return run


def _routes(batches) -> Iterator[tuple[int, list[tuple]]]:
    """Rows route by route (the partition is sorted by route)."""
    def rows():
        for b in batches:
            yield from zip(*(b.column(n).to_pylist() for n in ("route", "kind", "ord", "h", "data")))

    for route, group in groupby(rows(), key=lambda r: r[0]):
        yield route, list(group)


def _join_blobs(rows: list[tuple], kind: int, dtype: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(unpack(r[4]) for r in rows if r[1] == kind), dtype)


def _meet(rule: Rule, routes: int):
    def run(batches):
        for _, group in _routes(batches):
            out = [r for r in group if r[1] == SETTLED]
            cold = _join_blobs(group, BY_ANCHOR, ANCHOR)
            marks = np.unique(cold["a"][cold["n"] == 0])
            repeated, rest = settle(cold[cold["n"] > 0], rule.within)
            count = _contexts_per_anchor(rest)
            hot = np.isin(rest["a"], marks)
            is_open = hot | (count > 1)
            more, other = settle(_join_blobs(group, BY_CONTEXT, ANCHOR), rule.within)
            opened = np.concatenate([rest[is_open], other])
            sent = np.empty(len(opened), np.dtype([*OPENED.descr, ("ord", "<i8"), ("h", "<i8")]))
            for name in ("a", "at", "off", "n", "ord", "h"):
                sent[name] = opened[name]
            many = _rows_per_anchor(rest) > rule.group_limit  # a context that its document repeats has several rows
            sent["hot"] = np.concatenate([hot[is_open] | many[is_open], np.ones(len(other), bool)])
            out += _by_document(np.concatenate([repeated, more]), SETTLED, routes, RANGE)
            out += _by_document(sent, OPEN, routes, OPENED)
            if out:
                yield _batch(out)

    return run


def _fetch(rule: Rule, routes: int):
    """Contexts of open anchors, taken from their documents."""
    context = rule.context_type(rule)

    def flush(cold, hot):
        out = []
        if cold:
            rows = np.concatenate(cold)
            out += _by_route(rows, rows["a"], BY_ANCHOR, routes)
        if hot:
            repeated, rest = settle(np.concatenate(hot), rule.within)
            out += _by_document(repeated, SETTLED, routes, RANGE)
            out += _by_route(rest, mix(rest["a"] ^ rest["c"]), BY_CONTEXT, routes)
        return _batch(out)

    def run(batches):
        cold, hot, size = [], [], 0
        for b in batches:
            texts = [unpack(z) for z in byte_list(b.column("text_z"))]
            for i, (o, h, blobs) in enumerate(zip(b.column("ord").to_pylist(), b.column("h").to_pylist(), b.column("open").to_pylist())):
                rows = np.frombuffer(b"".join(blobs), OPENED)
                view = View([texts[i]], rule.words)
                small = rows[rows["hot"] == 0]
                if len(small):
                    cold.append(context.take(view, small, o, h))
                    size += len(small) * 8
                large = rows[rows["hot"] == 1]
                if len(large):
                    s = spread(large["at"].astype(np.int64), large["n"].astype(np.int64))
                    w = np.zeros(len(s), ANCHOR)
                    w["a"], w["c"] = np.repeat(large["a"], large["n"]), view.hashes(s, s + rule.length)
                    w["ord"], w["h"], w["at"], w["n"] = o, h, s, 1
                    hot.append(w)
                    size += len(w)
                if size >= FLUSH_ROWS:
                    yield flush(cold, hot)
                    cold, hot, size = [], [], 0
        if cold or hot:
            yield flush(cold, hot)

    return run


def _resolve(rule: Rule, routes: int):
    context = rule.context_type(rule)

    def run(batches):
        for _, group in _routes(batches):
            out = [r for r in group if r[1] == SETTLED]
            repeated, _ = settle(_join_blobs(group, BY_CONTEXT, ANCHOR), rule.within)
            out += _by_document(repeated, SETTLED, routes, RANGE)
            rows = _join_blobs(group, BY_ANCHOR, context.dtype)
            if len(rows):
                out += _by_document(rule.resolve(rule, rows[np.argsort(rows["a"], kind="stable")]), SETTLED, routes, RANGE)
            if out:
                yield _batch(out)

    return run


def packed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``ord, h, text_z``: texts packed for the shuffle."""
    def run(batches):
        for b in small_batches(batches):
            packer = zstandard.ZstdCompressor(level=1)
            yield pa.RecordBatch.from_arrays([b.column("ord"), b.column("h"), pa.array([packer.compress(t) for t in byte_list(b.column("text"))], pa.binary())],
                                             ["ord", "h", "text_z"])

    return keyed(docs, id_col, text_col).mapInArrow(run, "ord long, h long, text_z binary")


def repeated_windows(docs: DataFrame, rule: Rule, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``ord, h, ranges``: per document with repeats the packed ranges of windows that also start earlier."""
    count = partitions(docs.sparkSession)
    routes = ROUTES_PER_PARTITION * count

    def dealt(df):
        return df.repartitionById(count, F.col("route") % count).sortWithinPartitions("route")

    found = keyed(docs, id_col, text_col).mapInArrow(_find(rule, routes), ROUTED)
    met = stored(dealt(found).mapInArrow(_meet(rule, routes), ROUTED), "met")
    opened = met.where(F.col("kind") == OPEN).groupBy("ord", "h").agg(F.collect_list("data").alias("open"))
    # Repeated rows give the same contexts: one of them stands for all, else they would find each other as earlier places.
    texts = packed_texts(docs, id_col, text_col).join(opened, ["ord", "h"]).dropDuplicates(["ord", "h"])
    fetched = texts.mapInArrow(_fetch(rule, routes), ROUTED)
    solved = dealt(fetched).mapInArrow(_resolve(rule, routes), ROUTED)
    settled = met.where(F.col("kind") == SETTLED).unionByName(solved)
    return settled.groupBy("ord", "h").agg(F.collect_list("data").alias("ranges"))


def with_repeats(docs: DataFrame, rule: Rule, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``ord, h, text_z, ranges`` of every row (NULL ranges: no repeats)."""
    return packed_texts(docs, id_col, text_col).join(repeated_windows(docs, rule, id_col, text_col), ["ord", "h"], "left")


def covered(ranges: list[bytes] | None, units: int, length: int) -> np.ndarray:
    """Which units of a document lie in a repeated window."""
    if not ranges:
        return np.zeros(units, bool)
    r = np.frombuffer(b"".join(ranges), RANGE)
    delta = np.zeros(units + 1, np.int64)
    np.add.at(delta, r["at"].astype(np.int64), 1)
    np.add.at(delta, r["at"].astype(np.int64) + r["n"] + length - 1, -1)
    return np.cumsum(delta[:-1]) > 0
