"""Substring duplicates by seed and extend over words.

Documents meet on winnowed anchors (``repeats``). Two occurrences of an anchor
are extended both ways, word by word, as long as they agree; a maximal repeat of
``length`` words or more is taken from the later document. Extension stops where
the anchor's context stops: windows beyond it have other anchors, whose own
extension covers them.

Defined results: NULL and blank texts have no words; texts under ``length``
words lose nothing; repeats inside one document stay; rows that repeat an id
and text get the same answer, rows that share only the id are ordered by text
hash; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import byte_list, original_id
from shelfwise.llm.repeats import Rule, View, covered, spread, unpack, with_repeats

WINDOW = 13
SEED = 4
#: Occurrences of an anchor that are paired; beyond that its windows are compared by hash.
PAIRED = 48
_PAIRS_AT_ONCE = 100_000


class Words:
    """Context rows: the word hashes around an anchor, aligned at it."""

    def __init__(self, rule: Rule):
        self.left = rule.width - 1
        self.size = self.left + rule.length
        self.dtype = np.dtype([("a", "<u8"), ("ord", "<i8"), ("h", "<i8"), ("at", "<u4"), ("off", "u1"), ("n", "u1"), ("w", "<u8", (self.size,))])
        self.length = rule.length

    def take(self, view: View, rows: np.ndarray, ord_: int, h: int) -> np.ndarray:
        out = np.zeros(len(rows), self.dtype)
        for name in ("a", "at", "off", "n"):
            out[name] = rows[name]
        out["ord"], out["h"] = ord_, h
        n = rows["n"].astype(np.int64) + self.length - 1
        words = spread(rows["at"].astype(np.int64), n)
        row = np.repeat(np.arange(len(rows)), n)
        column = spread(self.left - rows["off"].astype(np.int64), n)
        out["w"][row, column] = view.hashes(words, words + 1) | np.uint64(1)  # 0: beyond the context
        return out


def extend(rule: Rule, rows: np.ndarray) -> np.ndarray:
    """Ranges of windows that an earlier occurrence of their anchor also has."""
    left = rule.width - 1
    rows = rows[np.lexsort((rows["at"], rows["h"], rows["ord"], rows["a"]))]
    head = np.flatnonzero(np.concatenate([[True], rows["a"][1:] != rows["a"][:-1]]))
    size = np.diff(np.concatenate([head, [len(rows)]]))
    earlier = np.arange(len(rows)) - np.repeat(head, size)  # rows of the group before this one
    out = []
    cuts = np.searchsorted(np.cumsum(earlier), np.arange(0, int(earlier.sum()) + 1, _PAIRS_AT_ONCE))
    for lo, hi in zip(cuts, [*cuts[1:], len(rows)]):
        n = earlier[lo:hi]
        later = np.repeat(np.arange(lo, hi), n)
        first = spread(np.arange(lo, hi) - n, n)
        other = (rows["ord"][first] != rows["ord"][later]) | (rows["h"][first] != rows["h"][later])
        first, later = first[other], later[other]
        if not len(later):
            continue
        x, y = rows["w"][first], rows["w"][later]
        agree = (x == y) & (x != 0)
        before = np.cumprod(agree[:, left - 1::-1], axis=1).sum(axis=1) if left else np.zeros(len(later), np.int64)
        after = np.cumprod(agree[:, left:], axis=1).sum(axis=1)
        whole = before + after >= rule.length
        later, before, after = later[whole], before[whole], after[whole]
        own = rows[later]
        place = own["at"].astype(np.int64) + own["off"]
        start = np.maximum(place - before, own["at"])
        stop = np.minimum(place + after - rule.length, own["at"].astype(np.int64) + own["n"] - 1)
        some = np.empty(len(later), np.dtype([("ord", "<i8"), ("h", "<i8"), ("at", "<u4"), ("n", "<u4")]))
        some["ord"], some["h"], some["at"], some["n"] = own["ord"], own["h"], start, np.maximum(stop - start + 1, 0)
        out.append(some[stop >= start])
    return np.concatenate(out) if out else np.zeros(0, [("ord", "<i8"), ("h", "<i8"), ("at", "<u4"), ("n", "<u4")])


def rule(length: int = WINDOW, seed: int = SEED) -> Rule:
    if not 1 <= seed <= length <= 128:
        raise ValueError("seed <= length <= 128 words")
    return Rule(words=True, length=length, seed=seed, within=False, group_limit=PAIRED, resolve=extend, context_type=Words)


def remove_repeats(docs: DataFrame, length: int = WINDOW, seed: int = SEED, *, with_text: bool = False,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``ord, h, n_words, n_removed, kept_sha256`` of every row, and the kept words with ``with_text``."""
    own = rule(length, seed)

    def run(batches):
        for b in batches:
            counts, removed, shas, kept = [], [], [], []
            for z, ranges in zip(byte_list(b.column("text_z")), b.column("ranges").to_pylist()):
                words = unpack(z).split()
                gone = covered(ranges, len(words), own.length)
                left = b" ".join(w for w, g in zip(words, gone.tolist()) if not g) if ranges else b" ".join(words)
                counts.append(len(words))
                removed.append(int(gone.sum()))
                shas.append(hashlib.sha256(left).hexdigest())
                kept.append(left.decode() if with_text else None)
            yield pa.RecordBatch.from_arrays([b.column("ord"), b.column("h"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(shas, pa.string()), pa.array(kept, pa.string())],
                                             ["ord", "h", "n_words", "n_removed", "kept_sha256", "kept"])

    schema = "ord long, h long, n_words long, n_removed long, kept_sha256 string, kept string"
    return with_repeats(docs, own, id_col, text_col).mapInArrow(run, schema)


def as_contract(found: DataFrame) -> DataFrame:
    return found.select(original_id().alias("doc_id"), "n_words", "n_removed", "kept_sha256")
