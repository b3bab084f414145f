"""Repeated byte strings by longest-previous-factor arrays.

Documents meet on winnowed anchors (``repeats``). The contexts that meet in a
bucket are sorted as suffixes: all window starts they own, by their next
``length`` bytes. The previous and the next smaller text position in suffix
order, with the common prefixes on the way, give each start's longest earlier
match; starts whose match is ``length`` bytes or more are repeats, and later
copies go while the first stays.

Defined results: NULL is the empty text; texts under ``length`` bytes lose
nothing; earlier means a smaller doc_id (a NULL id is the largest), or an earlier
start in the same document; rows that repeat an id and text get the same answer,
rows that share only the id are ordered by text hash; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfwise.llm.common import byte_list, original_id
from shelfwise.llm.repeats import Rule, View, covered, spread, unpack, with_repeats

WINDOW = 100
SEED = 24
#: Contexts of one anchor that are sorted as suffixes; beyond that its windows are compared by hash.
SORTED = 2048


class Bytes:
    """Context rows: the bytes that an anchor's windows cover."""

    def __init__(self, rule: Rule):
        self.size = rule.width - 1 + rule.length
        self.length = rule.length
        self.dtype = np.dtype([("a", "<u8"), ("ord", "<i8"), ("h", "<i8"), ("at", "<u4"), ("off", "u1"), ("n", "u1"), ("b", "u1", (self.size,))])

    def take(self, view: View, rows: np.ndarray, ord_: int, h: int) -> np.ndarray:
        out = np.zeros(len(rows), self.dtype)
        for name in ("a", "at", "off", "n"):
            out[name] = rows[name]
        out["ord"], out["h"] = ord_, h
        n = rows["n"].astype(np.int64) + self.length - 1
        out["b"][np.repeat(np.arange(len(rows)), n), spread(np.zeros(len(rows), np.int64), n)] = view.data[spread(rows["at"].astype(np.int64), n)]
        return out


def suffix_order(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at ``starts`` by their next ``length`` bytes, equal ones as given,
    and the bytes each has in common with the one before (to a multiple of eight below ``length``)."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    order = np.arange(len(starts))
    common = np.zeros(len(starts), np.int64)
    group = np.zeros(len(starts), np.int64)  # by place in order
    open_ = np.arange(len(starts))  # places whose suffix isn't told from all others
    for skip in [*range(0, length - 7, 8), *([length - 8] if length % 8 and length > 8 else [])]:
        if not len(open_):
            break
        word = np.ascontiguousarray(eight[starts[order[open_]] + skip]).view(">u8").ravel().astype(np.uint64)
        within = np.lexsort((word, group[open_]))
        order[open_], word = order[open_][within], word[within]
        g = group[open_]
        same_group = g[1:] == g[:-1]
        same = same_group & (word[1:] == word[:-1])
        common[open_[1:][same_group & ~same]] = skip
        common[open_[1:][same]] = min(skip + 8, length)
        head = np.concatenate([[True], ~same])
        group[open_] = open_[head][np.cumsum(head) - 1]
        more = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        open_ = open_[more]
    return order, common


def longest_previous(position: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For suffixes in suffix order, with text ``position`` and the common prefix with the one before:
    the longest prefix shared with a suffix of smaller position."""
    def one_way(pos, com):
        n = len(pos)
        link, low = np.arange(-1, n - 1), com.copy()  # candidate for the previous smaller position, prefix shared with it
        todo = np.flatnonzero((link >= 0) & (pos[np.maximum(link, 0)] > pos))
        while len(todo):
            via = link[todo]
            low[todo] = np.minimum(low[todo], low[via])
            link[todo] = link[via]
            todo = todo[(link[todo] >= 0) & (pos[np.maximum(link[todo], 0)] > pos[todo]) & (low[todo] > 0)]
        return np.where((link >= 0) & (pos[np.maximum(link, 0)] < pos), low, 0)

    if not len(position):
        return np.zeros(0, np.int64)
    after = np.concatenate([[0], common[:0:-1]])
    return np.maximum(one_way(position, common), one_way(position[::-1], after)[::-1])


def earlier_matches(rule: Rule, rows: np.ndarray) -> np.ndarray:
    """Windows of the contexts that also start earlier."""
    rows = rows[np.lexsort((rows["at"], rows["h"], rows["ord"]))]  # text order
    n = rows["n"].astype(np.int64)
    size = rows["b"].shape[1]
    row = np.repeat(np.arange(len(rows)), n)
    shift = spread(np.zeros(len(rows), np.int64), n)
    order, common = suffix_order(rows["b"].ravel(), row * size + shift, rule.length)
    lpf = longest_previous(order, common)  # suffixes are numbered in text order
    again = np.sort(order[lpf >= rule.length])
    out = np.empty(len(again), np.dtype([("ord", "<i8"), ("h", "<i8"), ("at", "<u4"), ("n", "<u4")]))
    out["ord"], out["h"], out["at"], out["n"] = rows["ord"][row[again]], rows["h"][row[again]], rows["at"][row[again]] + shift[again], 1
    return out


def rule(length: int = WINDOW, seed: int = SEED) -> Rule:
    if not (8 <= seed <= length and length - seed < 255):
        raise ValueError("8 <= seed <= length < seed + 255")
    return Rule(words=False, length=length, seed=seed, within=True, group_limit=SORTED, resolve=earlier_matches, context_type=Bytes)


def remove_repeats(docs: DataFrame, length: int = WINDOW, seed: int = SEED, *, with_bytes: bool = False,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``ord, h, n_bytes, n_removed, n_spans, kept_sha256`` of every row, and the kept bytes with ``with_bytes``."""
    own = rule(length, seed)

    def run(batches):
        for b in batches:
            rows = []
            for z, ranges in zip(byte_list(b.column("text_z")), b.column("ranges").to_pylist()):
                text = unpack(z)
                left, removed, spans = text, 0, 0
                if ranges:
                    gone = covered(ranges, len(text), own.length)
                    left = np.frombuffer(text, np.uint8)[~gone].tobytes()
                    removed = int(gone.sum())
                    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                rows.append((len(text), removed, spans, hashlib.sha256(left).hexdigest(), left if with_bytes else None))
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column("ord"), b.column("h"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.binary())],
                ["ord", "h", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    schema = "ord long, h long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return with_repeats(docs, own, id_col, text_col).mapInArrow(run, schema)


def as_contract(found: DataFrame) -> DataFrame:
    return found.select(original_id().alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
