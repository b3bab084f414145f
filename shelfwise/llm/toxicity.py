"""Toxic spans by a linear-chain conditional random field with two states.

Labelled tokens come from labelled documents: a token of a toxic document is
toxic if its word, or five bytes in it, is many times as common in toxic
documents as in clean ones, by documents or by places (near copies count once). The field has one
weight per hashed word, five bytes, neighbour word and pair of states, fitted by
gradient steps on forward-backward expectations. Scoring runs forward-backward over whole texts;
token marginals give the offending character spans, and their expected number
and maximum give the document's score through a logistic curve.

Fitting takes a bounded sample (``labelled.ROWS_PER_LABEL``,
``labelled.MAX_CHARS``) to the driver; scoring needs no shuffle. The chain is
scanned in blocks: products of 2 x 2 matrices for many blocks at once, then one
short pass over the blocks, so long texts cost no more per token than short ones.

Defined results: NULL and wordless texts have no tokens and get the curve's
lowest value; without labels of both kinds every score is 0; repeated rows get
equal scores; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import byte_list, clean_text, keyed, small_batches
from shelfwise.llm.hashing import Rolling
from shelfwise.llm.labelled import held_out, logistic, sample

BITS = 20
GRAM = 5
BLOCK = 64
#: Tokens, or numbers, for which sums are made at once.
AT_ONCE = 1 << 17
#: Places of a word or gram in one text that count when labels are given to tokens.
OFTEN = 16
#: Same length as the input: lower-cases A-Z, blanks all ASCII but letters and digits.
_WORDS = bytes(b if b >= 0x80 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())


@dataclass
class Tokens:
    """All tokens of some texts: word numbers, start and stop bytes, each text's first token (and the end),
    and the number of the 5 bytes from each place on (the blanks around a word count)."""

    words: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    first: np.ndarray
    grams: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Tokens:
        data = np.frombuffer(b" " + b" ".join(t.translate(_WORDS) for t in texts) + b"     ", np.uint8)
        begin = np.concatenate([[1], 1 + np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
        blank = data == 32
        start, stop = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1, np.flatnonzero(~blank[:-1] & blank[1:]) + 1
        roll = Rolling(data)
        words = (roll.ranges(start, stop) >> np.uint64(64 - BITS)).astype(np.int64)
        grams = (roll.grams(GRAM) >> np.uint64(64 - BITS)).astype(np.int32)
        grams = np.concatenate([grams, np.zeros(len(data) - len(grams), np.int32)])
        return cls(words, start, stop, np.searchsorted(start, begin), grams)

    @classmethod
    def of_many(cls, texts: list[bytes], at_once: int = 200) -> Tokens:
        """The same, put together from small parts (hashing needs some ten times a part's size)."""
        parts = [cls.of(texts[i:i + at_once]) for i in range(0, max(len(texts), 1), at_once)]
        places = np.cumsum([0, *(len(p.grams) for p in parts)])
        tokens = np.cumsum([0, *(len(p.words) for p in parts)])
        return cls(np.concatenate([p.words for p in parts]),
                   np.concatenate([p.start + k for p, k in zip(parts, places)]), np.concatenate([p.stop + k for p, k in zip(parts, places)]),
                   np.concatenate([*(p.first[:-1] + k for p, k in zip(parts, tokens)), tokens[-1:]]), np.concatenate([p.grams for p in parts]))

    def starts(self) -> np.ndarray:
        out = np.zeros(len(self.words), bool)
        out[self.first[self.first < len(out)]] = True
        return out

    def gram_bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """First place of each token's grams and the place after its last."""
        return self.start - 1, np.maximum(self.stop + 2 - GRAM, self.start - 1)


def _scan(m00: np.ndarray, m01: np.ndarray, m10: np.ndarray, m11: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row vectors ``(1, 1) M_0 ... M_t`` for every t, each scaled to sum 1."""
    n = len(m00)
    columns = -(-n // BLOCK)
    blocks = []
    for m, rest in ((m00, 1.0), (m01, 0.0), (m10, 0.0), (m11, 1.0)):
        full = np.full(columns * BLOCK, rest)
        full[:n] = m
        blocks.append(np.ascontiguousarray(full.reshape(columns, BLOCK).T))
    a, b, c, d = blocks
    p, q, r, s = np.ones(columns), np.zeros(columns), np.zeros(columns), np.ones(columns)
    for t in range(BLOCK):
        p, q, r, s = p * a[t] + q * c[t], p * b[t] + q * d[t], r * a[t] + s * c[t], r * b[t] + s * d[t]
        if t % 8 == 7:
            scale = 1 / (p + q + r + s)
            p, q, r, s = p * scale, q * scale, r * scale, s * scale
    x, y = np.empty(columns), np.empty(columns)
    u, v = 0.5, 0.5
    for k, (kp, kq, kr, ks) in enumerate(zip(p.tolist(), q.tolist(), r.tolist(), s.tolist())):
        x[k], y[k] = u, v
        u, v = u * kp + v * kr, u * kq + v * ks
        total = u + v
        u, v = u / total, v / total
    left, right = np.empty((BLOCK, columns)), np.empty((BLOCK, columns))
    for t in range(BLOCK):
        x, y = x * a[t] + y * c[t], x * b[t] + y * d[t]
        scale = 1 / (x + y)
        x, y = x * scale, y * scale
        left[t], right[t] = x, y
    return left.T.reshape(-1)[:n], right.T.reshape(-1)[:n]


def _table() -> np.ndarray:
    return np.zeros(1 << BITS, np.float32)


@dataclass
class Field:
    """Weights: per word, gram and neighbour word; ``steps`` are the logs of state couples, ``begin`` of first states."""

    own: np.ndarray = field(default_factory=_table)
    gram: np.ndarray = field(default_factory=_table)
    before: np.ndarray = field(default_factory=_table)
    after: np.ndarray = field(default_factory=_table)
    steps: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    begin: np.ndarray = field(default_factory=lambda: np.zeros(2))
    bias: float = -3.0
    curve: np.ndarray | None = None

    def energies(self, t: Tokens, starts: np.ndarray) -> np.ndarray:
        e = (self.own[t.words] + self.bias).astype(np.float64)
        lo, hi = t.gram_bounds()
        total = 0.0
        for i in range(0, len(e), AT_ONCE):  # running sums of the grams, of some tokens at once
            j = min(i + AT_ONCE, len(e))
            first, end = lo[i] if i else 0, lo[j] if j < len(e) else hi[-1]
            sums = np.empty(end - first + 1)
            sums[0], sums[1:] = total, self.gram[t.grams[first:end]]
            np.cumsum(sums, out=sums)
            e[i:j] = e[i:j] + sums[hi[i:j] - first] - sums[lo[i:j] - first]
            total = sums[-1]
        e[1:] += np.where(starts[1:], 0, self.before[t.words[:-1]])
        e[:-1] += np.where(starts[1:], 0, self.after[t.words[1:]])
        return np.clip(e, -25, 25)

    def expectations(self, t: Tokens, pairs: bool = False):
        """Marginal of the toxic state per token and, with ``pairs``, the summed couples and first states."""
        n = len(t.words)
        if not n:
            return np.zeros(0), np.zeros((2, 2)), np.zeros(2)
        start = t.starts()
        up = np.exp(self.energies(t, start))
        s, i = np.exp(self.steps), np.exp(self.begin)
        m00, m10 = np.where(start, i[0], s[0, 0]), np.where(start, i[0], s[1, 0])
        m01, m11 = np.where(start, i[1], s[0, 1]) * up, np.where(start, i[1], s[1, 1]) * up
        f0, f1 = _scan(m00, m01, m10, m11)
        b0, b1 = np.full(n, 0.5), np.full(n, 0.5)
        if n > 1:
            g0, g1 = _scan(m00[:0:-1], m10[:0:-1], m01[:0:-1], m11[:0:-1])
            b0[:-1], b1[:-1] = g0[::-1], g1[::-1]
        p = f1 * b1 / (f0 * b0 + f1 * b1)
        if not pairs:
            return p, None, None
        inner = np.flatnonzero(~start)
        couples = np.stack([f0[inner - 1] * m00[inner] * b0[inner], f0[inner - 1] * m01[inner] * b1[inner],
                            f1[inner - 1] * m10[inner] * b0[inner], f1[inner - 1] * m11[inner] * b1[inner]])
        couples /= couples.sum(axis=0)
        return p, couples.sum(axis=1).reshape(2, 2), np.array([(1 - p[start]).sum(), p[start].sum()])

    def documents(self, p: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Per text: the largest marginal and the log of the expected number of toxic tokens."""
        count = np.diff(first)
        out = np.zeros((len(count), 2))
        some = np.flatnonzero(count)
        if len(some):
            out[some, 0] = np.maximum.reduceat(p, first[some])
            out[some, 1] = np.log1p(np.add.reduceat(np.where(p > 0.05, p, 0), first[some]))
        return out

    def scores(self, p: np.ndarray, first: np.ndarray) -> np.ndarray:
        x = self.documents(p, first)
        if self.curve is None:
            return np.zeros(len(x))
        return 1 / (1 + np.exp(-np.clip(x @ self.curve[:-1] + self.curve[-1], -30, 30)))


def _support(first: np.ndarray, number: np.ndarray, y: np.ndarray,
             at_once: int = AT_ONCE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """In how many toxic and in how many clean texts each number occurs, and how often (at most ``OFTEN`` times a text).

    ``first`` is the place of each text's first number, and the end. Some texts are counted at once, with
    about ``at_once`` numbers together: counting needs some fifty bytes a number.
    """
    out = tuple(np.zeros(1 << BITS, kind) for kind in (np.int64, np.int64, np.float64, np.float64))
    lo = 0
    while lo < len(y):
        hi = max(lo + 1, int(np.searchsorted(first, first[lo] + at_once, "right")) - 1)
        hi = min(hi, len(y))
        doc = np.repeat(np.arange(lo, hi), np.diff(first[lo:hi + 1]))
        seen, times = np.unique(doc << BITS | number[first[lo]:first[hi]], return_counts=True)
        label, of = y[seen >> BITS], seen & ((1 << BITS) - 1)
        times = np.minimum(times, OFTEN)
        for total, k, weights in zip(out, (1, 0, 1, 0), (None, None, times, times)):
            total += np.bincount(of[label == k], None if weights is None else weights[label == k], 1 << BITS)
        lo = hi
    return out


def _sums(number: np.ndarray, gap: np.ndarray, of: np.ndarray, at_once: int = 1 << 20) -> np.ndarray:
    """The sum of ``gap[of]`` per number, without an array of all of them; few numbers are counted at once."""
    out = np.zeros(1 << BITS)
    for lo in range(0, len(number), at_once):
        out += np.bincount(number[lo:lo + at_once], gap[of[lo:lo + at_once]], 1 << BITS)
    return out


def _telling(toxic: np.ndarray, clean: np.ndarray, often: np.ndarray, seldom: np.ndarray, y: np.ndarray,
             least: float = 12.0, texts: int = 6) -> np.ndarray:
    """Numbers ``least`` times as common in toxic texts as in clean ones, by texts or by places, in enough toxic texts."""
    n, rest = max((y == 1).sum(), 1), (y == 0).sum() + 1
    by_texts, by_places = (toxic / n) / ((clean + 0.5) / rest), (often / n) / ((seldom + 0.5) / rest)
    return (np.maximum(by_texts, by_places) >= least) & (toxic >= max(texts, 0.01 * n))


def fit(texts: list[bytes], y: np.ndarray, odds: float = 0.0, rounds: int = 40, rate: float = 0.5, ridge: float = 1e-3) -> Field:
    """The field on four fifths of the texts, the curve on the rest, moved to the log ``odds`` of label 1."""
    model = Field()
    part = np.zeros(len(y), np.int64)
    for label in (0, 1):
        part[np.flatnonzero(y == label)] = np.arange((y == label).sum()) % 5
    if len(set(y[part < 4].tolist())) < 2:
        return model
    t, labels = Tokens.of_many([x for x, k in zip(texts, part) if k < 4]), y[part < 4]
    starts = t.starts()
    doc = np.repeat(np.arange(len(labels)), np.diff(t.first))
    lo, hi = t.gram_bounds()
    size = hi - lo
    token = np.repeat(np.arange(len(t.words), dtype=np.int32), size)
    place = np.repeat((lo - np.concatenate([[0], np.cumsum(size)[:-1]])).astype(np.int32), size)
    place += np.arange(size.sum(), dtype=np.int32)
    grams = t.grams[place]
    del place
    word_counts, gram_counts = _support(t.first, t.words, labels), _support(np.concatenate([[0], np.cumsum(size)])[t.first], grams, labels)
    named = _telling(*word_counts, labels)[t.words]
    named[token[_telling(*gram_counts, labels)[grams]]] = True
    truth = named & (labels[doc] == 1)
    # A number of few texts would only be learnt by heart.
    words_used, grams_used = sum(word_counts[:2]) >= 5, sum(gram_counts[:2]) >= 5
    near_used = sum(word_counts[:2]) >= 50
    del word_counts, gram_counts
    state = truth.astype(np.int64)
    inner = np.flatnonzero(~starts)
    couples = np.bincount(2 * state[inner - 1] + state[inner], minlength=4).reshape(2, 2)
    firsts = np.bincount(state[starts], minlength=2)
    uses = (("own", np.arange(len(t.words)), t.words, words_used), ("gram", token, grams, grams_used),
            ("before", inner, t.words[inner - 1], near_used), ("after", inner - 1, t.words[inner], near_used))
    sums = {name: np.full(1 << BITS, 1.0) for name, *_ in uses}
    step_sum, begin_sum, bias_sum = np.full((2, 2), 1.0), np.full(2, 1.0), 1.0
    for _ in range(rounds):
        p, pairs, begins = model.expectations(t, pairs=True)
        gap = truth - p
        for name, of, number, used in uses:
            weight = getattr(model, name)
            grad = (_sums(number, gap, of) - ridge * (y == 1).sum() * weight) * used
            sums[name] += grad * grad
            weight += (rate * grad / np.sqrt(sums[name])).astype(np.float32)
        for value, grad, total in ((model.steps, couples - pairs, step_sum), (model.begin, firsts - begins, begin_sum)):
            total += grad * grad
            value += rate * grad / np.sqrt(total)
        bias_sum += gap.sum() ** 2
        model.bias += rate * gap.sum() / bias_sum ** 0.5
    rest = part == 4 if len(set(y[part == 4].tolist())) == 2 else part >= 0
    t = Tokens.of_many([x for x, k in zip(texts, rest) if k])
    model.curve = logistic(model.documents(model.expectations(t)[0], t.first), y[rest], ridge=0.1)
    model.curve[-1] += odds - np.log(y[rest].sum() / (1 - y[rest]).sum())
    return model


def _spans(texts: list[bytes], t: Tokens, toxic: np.ndarray) -> list[list[dict]]:
    """Per text the character ranges of runs of ``toxic`` tokens."""
    out = [[] for _ in texts]
    if not len(toxic):
        return out
    begin = np.concatenate([[1], 1 + np.cumsum([len(x) + 1 for x in texts])])
    chars = np.cumsum((np.frombuffer(b" " + b" ".join(texts), np.uint8) & 0xC0) != 0x80)
    doc = np.searchsorted(t.first, toxic, "right") - 1
    head = np.flatnonzero(np.concatenate([[True], (np.diff(toxic) != 1) | (np.diff(doc) != 0)]))
    tail = np.concatenate([head[1:], [len(toxic)]]) - 1
    base = chars[begin[doc[head]] - 1]
    lo, hi = chars[t.start[toxic[head]] - 1] - base, chars[t.stop[toxic[tail]] - 1] - base
    for d, x, y in zip(doc[head].tolist(), lo.tolist(), hi.tolist()):
        out[d].append({"start": x, "stop": y})
    return out


def tag(docs: DataFrame, model: Field, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``ord, h, score, spans`` of every row; spans are character ranges of runs of toxic tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        fitted = shared.value
        for b in small_batches(batches, lean=True):
            texts = byte_list(b.column("text"))
            t = Tokens.of(texts)
            p, _, _ = fitted.expectations(t)
            spans = _spans(texts, t, np.flatnonzero(p >= threshold))
            yield pa.RecordBatch.from_arrays(
                [b.column("ord"), b.column("h"), pa.array(fitted.scores(p, t.first)),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))], ["ord", "h", "score", "spans"])

    return keyed(docs, id_col, text_col).mapInArrow(run, "ord long, h long, score double, spans array<struct<start:int,stop:int>>")


def as_contract(docs: DataFrame, labels: DataFrame) -> DataFrame:
    from shelfwise.llm.common import original_id

    model = fit(*sample(docs, labels, "toxic", 4, 2))
    return (tag(docs, model).withColumn("doc_id", original_id())
            .select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score",
                    (F.col("score") >= 0.3).cast("int").alias("predicted"), "spans"))
