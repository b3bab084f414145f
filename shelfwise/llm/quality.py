"""Quality classifier: naive-Bayes features in a linear support vector machine.

Features are n-gram indicators: byte 3-grams, words and word couples, hashed, and
words that follow themselves.
Each indicator is scaled by the log ratio of its class counts and rows are
scaled to unit length; a linear hinge-loss model is fitted by dual coordinate
descent, then a logistic curve maps its margin to a probability. Fitting takes
a bounded sample (``ROWS_PER_LABEL``, ``labelled.MAX_CHARS``) to the
driver; scoring reads every whole text in its scan task, without a shuffle.

Defined results: NULL and empty texts have no features and get the curve's value
at margin zero; without labels of both kinds every score is the share of label
1 (0.5 if there are none); repeated rows get equal scores; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import byte_list, clean_text, small_batches
from shelfwise.llm.hashing import Rolling
from shelfwise.llm.labelled import held_out, logistic, sample

BITS = 18
SIZE = 1 << BITS
#: Rows of each label that the query fits on.
ROWS_PER_LABEL = 3000


def features(data: np.ndarray, bounds: np.ndarray):
    """Per text of a buffer (``bounds``: where each begins, and the end) its distinct feature numbers.

    Byte 3-grams take the lower half of the numbers, words and couples the upper.
    """
    codes = data.astype(np.uint32)
    if len(codes) >= 3:
        codes = (codes[:-2] | codes[1:-1] << 8 | codes[2:] << 16) * np.uint32(0x9E3779B1) >> np.uint32(33 - BITS)
    else:
        codes = codes[:0]
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.concatenate([[True], blank, [True]])
    start, stop = np.flatnonzero(edge[:-1] & ~edge[1:]), np.flatnonzero(~edge[:-1] & edge[1:])
    roll = Rolling(data)
    word = roll.ranges(start, stop)
    couple = word[:-1] * np.uint64(31) + word[1:]
    half = np.uint64(64 - BITS + 1)
    word = (word >> half).astype(np.uint32) + np.uint32(SIZE // 2)
    couple = ((couple * np.uint64(0xD6E8FEB86659FD93)) >> half).astype(np.uint32) + np.uint32(SIZE // 2)
    # any word said twice in a row, and any said three times, are couples and triples of their own
    twice = word[:-1] == word[1:]
    couple = np.concatenate([couple, np.where(twice, SIZE // 2 + 1, couple), np.where(twice & np.concatenate([twice[1:], [False]]), SIZE // 2 + 2, couple)]).reshape(3, -1)
    first = np.searchsorted(start, bounds)
    place = np.zeros(SIZE, np.int32)
    for i in range(len(bounds) - 1):
        a, b, u, v = bounds[i], bounds[i + 1], first[i], first[i + 1]
        own = np.concatenate([codes[a:max(a, b - 2)], word[u:v], *couple[:, u:max(u, v - 1)]])
        at = np.arange(len(own), dtype=np.int32)
        place[own] = at
        yield own[place[own] == at]


@dataclass
class Model:
    weights: np.ndarray
    slope: float
    shift: float

    def margins(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return np.array([self.weights[f].sum(dtype=np.float64) / max(len(f), 1) ** 0.5 for f in features(data, bounds)])

    def scores(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(data, bounds) + self.shift, -30, 30)))


def _buffer(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts each followed by a blank (so that no word crosses); where each begins."""
    sizes = [len(t) + 1 for t in texts]
    return np.frombuffer(b"".join(t + b" " for t in texts), np.uint8), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def fit(texts: list[bytes], y: np.ndarray, odds: float = 0.0, cost: float = 1.0, rounds: int = 12, alpha: float = 1.0) -> Model:
    """Log-count ratios and dual coordinate descent on four fifths, the probability curve on the rest, moved to the log ``odds`` of label 1."""
    if len(set(y.tolist())) < 2:
        share = min(max(float(y.mean()) if len(y) else 0.5, 0.01), 0.99)
        return Model(np.zeros(SIZE, np.float32), 0.0, float(np.log(share / (1 - share))))
    rows = [f for i in range(0, len(texts), 200) for f in features(*_buffer(texts[i:i + 200]))]  # hashing needs some ten times a part's size
    part = np.zeros(len(y), np.int64)  # every fifth row of each label is for the curve
    for label in (0, 1):
        part[np.flatnonzero(y == label)] = np.arange((y == label).sum()) % 5
    train = np.flatnonzero(part != 4)
    counts = np.full((2, SIZE), alpha)
    for i in train:
        counts[y[i], rows[i]] += 1
    ratio = np.log((counts[1] / ((y[train] == 1).sum() + 2 * alpha)) / (counts[0] / ((y[train] == 0).sum() + 2 * alpha)))
    sign = np.where(y == 1, 1.0, -1.0)
    limit = cost * len(train) / (2 * np.where(y == 1, (y[train] == 1).sum(), (y[train] == 0).sum()))
    scaled = {i: ratio[rows[i]] / max(len(rows[i]), 1) ** 0.5 for i in train}
    norm = {i: float(v @ v) for i, v in scaled.items()}
    dual, w, order = np.zeros(len(y)), np.zeros(SIZE), np.random.default_rng(7)
    for _ in range(rounds):
        change = 0.0
        for i in order.permutation(train):
            if norm[i] > 0:
                gradient = sign[i] * (w[rows[i]] @ scaled[i]) - 1
                new = min(max(dual[i] - gradient / norm[i], 0.0), limit[i])
                if new != dual[i]:
                    w[rows[i]] += (new - dual[i]) * sign[i] * scaled[i]
                    change = max(change, abs(new - dual[i]))
                    dual[i] = new
        if change < 1e-3:
            break
    model = Model((w * ratio).astype(np.float32), 1.0, 0.0)
    curve = np.flatnonzero(part == 4)
    if len(set(y[curve].tolist())) < 2:
        curve = np.arange(len(y))
    margin = np.array([model.weights[rows[i]].sum(dtype=np.float64) / max(len(rows[i]), 1) ** 0.5 for i in curve])
    model.slope, model.shift = map(float, logistic(margin[:, None], y[curve], ridge=0.1))
    model.shift += odds - float(np.log(y[curve].sum() / (1 - y[curve]).sum()))
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        fitted = shared.value
        for b in small_batches(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fitted.scores(*_buffer(byte_list(b.column("text")))))], ["doc_id", "score"])

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), clean_text(docs[text_col]).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def as_contract(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(*sample(docs, labels, "quality", 3, 1, rows_per_label=ROWS_PER_LABEL))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score",
                                     (F.col("score") >= 0.5).cast("int").alias("predicted"))
