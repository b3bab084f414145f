"""C4: truncated text corpus, word mode (native) and tokenizer mode.

Truncation to the first N tokens is the operator (the original's
``max_seq_length``).

* word mode: whitespace tokens, a JVM regular expression (``truncate_words``);
* tokenizer mode: a caller-supplied tokenizer runs in ``mapInArrow``, built once
  per task. It has ``encode(text, limit)``, which stops after ``limit`` ids, and
  ``decode(ids)``. ``subword.SubwordTokenizer`` is byte-pair encoding over a vocabulary
  table; ``ByteTokenizer`` (UTF-8 bytes, the byte-level vocabulary of ByT5) needs no file.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.fixed_values import MAX_TEXT_TOKENS
from shelfwise.functions.text import truncate_words


def truncate_texts(texts: DataFrame, max_tokens: int = MAX_TEXT_TOKENS) -> DataFrame:
    """``item_id, item_text`` with at most ``max_tokens`` words per text."""
    # made by a generator, below which no later filter goes: a text is cut once, not again for the filter
    return texts.select("item_id", F.explode(F.array(truncate_words(F.col("item_text"), max_tokens))).alias("item_text"))


class ByteTokenizer:
    """UTF-8 byte ids offset by 3 (pad, eos, unk), without special tokens."""

    offset = 3

    def encode(self, text: str, limit: int | None = None) -> list[int]:
        return [b + self.offset for b in text[:limit].encode("utf-8")[:limit]]

    def decode(self, ids: list[int]) -> str:
        return bytes(i - self.offset for i in ids if i >= self.offset).decode("utf-8", errors="ignore")


def truncate_texts_tokenizer(
    texts: DataFrame,
    tokenizer_factory: Callable[[], object] = ByteTokenizer,
    max_tokens: int = MAX_TEXT_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """``item_id, item_text[, input_ids]`` cut to ``max_tokens`` tokenizer ids; a NULL text stays NULL."""
    schema = "item_id bigint, item_text string" + (", input_ids array<int>" if with_ids else "")
    types = [pa.int64(), pa.string(), pa.list_(pa.int32())]
    names = ["item_id", "item_text", "input_ids"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer_factory()
        for batch in batches:
            ids = [None if t is None else tok.encode(t, max_tokens) for t in batch.column("item_text").to_pylist()]
            columns = [batch.column("item_id").cast(types[0]), pa.array([None if i is None else tok.decode(i) for i in ids], types[1])]
            columns += [pa.array(ids, types[2])] if with_ids else []
            yield pa.RecordBatch.from_arrays(columns, names[:len(columns)])

    return texts.select("item_id", "item_text").mapInArrow(apply, schema)


def tokenize_prompts(
    prompts: DataFrame,
    tokenizer_factory: Callable[[], object] = ByteTokenizer,
    eos_id: int | None = 1,
) -> DataFrame:
    """Prompt features for a trainer: ``input_ids`` (and ``labels`` when the
    table has ``label_word``) as ``array<int>``, the tokenizer's ids plus an
    optional end-of-sequence id, as the original's text-to-text datasets built
    them. All other columns pass through unchanged.
    """
    has_label = "label_word" in prompts.columns
    ids = T.ArrayType(T.IntegerType())
    extra = [T.StructField("input_ids", ids)] + ([T.StructField("labels", ids)] if has_label else [])
    out_schema = T.StructType(list(prompts.schema.fields) + extra)
    tail = [] if eos_id is None else [eos_id]

    def encode(tok, text):
        return None if text is None else list(tok.encode(text)) + tail

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = tokenizer_factory()
        for batch in batches:
            batch = batch.copy()
            batch["input_ids"] = [encode(tok, t) for t in batch["prompt"]]
            if has_label:
                batch["labels"] = [encode(tok, t) for t in batch["label_word"]]
            yield batch

    return prompts.mapInPandas(apply, out_schema)
