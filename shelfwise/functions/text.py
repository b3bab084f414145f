"""String helpers: text truncation, file stems, answer cleaning, run names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.fixed_values import EOS_MARKER, NA_TOKENS, PAD_MARKER


# Whitespace between word tokens: the characters Java's and RE2's ``\s`` both
# match (vertical tab excluded), so the result does not depend on the engine.
WHITESPACE = "[\t\n\f\r ]"


def truncate_words(col: Column, max_tokens: int) -> Column:
    """F7 word mode: first ``max_tokens`` whitespace tokens joined by one blank.

    White space around the text goes. The split stops after ``max_tokens``
    tokens, so a long text isn't split into all its words to keep a few, and
    what lies well behind them isn't searched for white space at all.
    """
    if max_tokens < 1:
        raise ValueError("max_tokens must be >= 1")
    word = f"[^{WHITESPACE[1:-1]}]"
    # Two words more than wanted: the strip below, whose $ also stands before a
    # line separator that ends the text, joins no others than these.
    head = F.regexp_extract(col, f"^{WHITESPACE}*+((?:{word}++{WHITESPACE}*+){{0,{max_tokens + 2}}}+)", 1)
    bare = F.regexp_replace(head, f"{WHITESPACE}+$", "")
    return F.array_join(F.slice(F.split(bare, WHITESPACE + "+", max_tokens + 1), 1, max_tokens), " ")


def file_stem(path: Column) -> Column:
    """file name up to its first dot (``/a/b/12.text`` -> ``12``)."""
    return F.regexp_extract(path, r"([^/.]*)[^/]*$", 1)


def run_name_from_path(path: Column) -> Column:
    """``.../params/<run>.json`` -> ``<run>``."""
    return F.regexp_extract(path, r"([^/]+)\.json$", 1)


def strip_ws(col: Column) -> Column:
    """Python ``str.strip()`` for ASCII whitespace."""
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def clean_prediction(col: Column) -> Column:
    """text between the first ``<pad>`` and the next ``</s>``, stripped.

    Without ``<pad>`` the answer is the empty string (counted as wrong).
    """
    after_pad = F.split_part(col, F.lit(PAD_MARKER), F.lit(2))
    return strip_ws(F.split_part(after_pad, F.lit(EOS_MARKER), F.lit(1)))


def na_to_null(col: Column) -> Column:
    """pandas' default missing-value tokens become NULL (TSV reads only)."""
    return F.when(~col.isin(*NA_TOKENS), col)
