"""Truncation to the first N subword tokens that stops after N tokens.

Byte-pair encoding with a vocabulary table ``(token, rank)``: a text is cut into
pieces by a pattern, one piece at a time; inside a piece the neighbouring pair
whose union has the lowest rank is joined first. The pairs wait in a priority
queue, so a piece of n bytes costs n log n, and as pieces are taken until N
tokens are there, the cost of a text follows N and not its length (but for
a piece that is long itself). Byte-level tokens hold a text's bytes, so the first
N tokens decode to the front of the text; bytes of a character that N cuts
through are left out.

The vocabulary is read once by Spark and broadcast (some 50,000 tokens, about a
megabyte); tasks keep pieces that recur in a bounded cache.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.fixed_values import MAX_TEXT_TOKENS
from shelfwise.operators.truncate import truncate_texts_tokenizer

_CACHED = 1 << 16
_CACHED_BYTES = 64


def read_vocabulary(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Lines of a token in base64 and its rank, the format of rank files."""
    rows = spark.read.text(path).where(F.trim("value") != "").select(
        F.unbase64(F.split_part("value", F.lit(" "), F.lit(1))).alias("token"), F.split_part("value", F.lit(" "), F.lit(2)).cast("int").alias("rank"))
    return {bytes(r["token"]): r["rank"] for r in rows.collect()}


def encode_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one piece: pairs are joined by rank, the leftmost first of equal ones."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    queue = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (rank := ranks.get(piece[i:end[j]])) is not None:
            heapq.heappush(queue, (rank, i, end[j]))

    for i in range(n - 1):
        offer(i)
    while queue:
        _, i, stop = heapq.heappop(queue)
        j = after[i] if end[i] else n
        if j >= n or end[j] != stop:  # one of the two was joined meanwhile
            continue
        end[i], after[i], end[j] = stop, after[j], 0
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = after[i]
    return out


class SubwordTokenizer:
    """Encodes the front of a text; the tokenizer plug-in ``truncate.tokenize_prompts`` takes as well."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.cache: dict[str, list[int]] = {}

    def _piece(self, piece: str) -> list[int]:
        ids = self.cache.get(piece)
        if ids is None:
            ids = encode_piece(piece.encode(), self.ranks)
            if len(piece) <= _CACHED_BYTES:
                if len(self.cache) >= _CACHED:
                    self.cache.clear()
                self.cache[piece] = ids
        return ids

    def encode(self, text: str, limit: int | None = None) -> list[int]:
        out: list[int] = []
        for found in self.pattern.finditer(text):
            out += self._piece(found[0])
            if limit is not None and len(out) >= limit:
                return out[:limit]
        return out

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(self.tokens[i] for i in ids).decode("utf-8", errors="ignore")


def subword_factory(spark: SparkSession, vocabulary: str, pattern: str) -> Callable[[], SubwordTokenizer]:
    """Builds the tokenizer in a task from the broadcast vocabulary.

    ``vocabulary`` is the path of a rank file that all executors can read,
    ``pattern`` the regular expression that cuts a text into pieces.
    """
    ranks = spark.sparkContext.broadcast(read_vocabulary(spark, vocabulary))
    return lambda: SubwordTokenizer(ranks.value, pattern)


def truncate_texts_subword(texts: DataFrame, vocabulary: str, pattern: str, max_tokens: int = MAX_TEXT_TOKENS) -> DataFrame:
    """``item_id, item_text, input_ids`` of ``texts (item_id, item_text)`` cut to ``max_tokens`` subword tokens."""
    return truncate_texts_tokenizer(texts, subword_factory(texts.sparkSession, vocabulary, pattern), max_tokens, with_ids=True)
