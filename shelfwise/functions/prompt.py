"""Prompt rendering (F8-F10) and label words (F11) as Column expressions.

Rendering is literal and sequential: each ``*name*`` placeholder is replaced in
a fixed order, so a placeholder that appears inside an inserted value (an item
text mentioning ``*user_genres*``) is replaced by a later step, as in the
original renderer. The user-genre step is conditional: with an empty profile
only the exact cold-start phrase is rewritten; other templates keep the literal
``*user_genres*``.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.fixed_values import (
    COLD_START_PHRASE,
    COLD_START_REPLACEMENT,
    STRUCTURED_PLACEHOLDERS,
    TEXT_PLACEHOLDERS,
)


def _text_of(name: str) -> Column:
    c = F.col(name)
    if name in ("user_id", "item_id"):
        c = c.cast("string")
    # F.replace is NULL if any argument is NULL: missing values render as ''.
    return F.coalesce(c, F.lit(""))


def render(
    template: Column,
    placeholders: Sequence[str],
    cold_start: tuple[str, str] = (COLD_START_PHRASE, COLD_START_REPLACEMENT),
) -> Column:
    """Replace ``*p*`` by column ``p`` for each placeholder, then user genres."""
    t = template
    for name in placeholders:
        t = F.replace(t, F.lit(f"*{name}*"), _text_of(name))
    return _genre_step(t, cold_start)


def _genre_step(text: Column, cold_start: tuple[str, str], genres: Column | None = None) -> Column:
    genres = _text_of("user_genres") if genres is None else genres
    phrase, replacement = cold_start
    return F.when(genres != "", F.replace(text, F.lit("*user_genres*"), genres)).otherwise(
        F.replace(text, F.lit(phrase), F.lit(replacement))
    )


_TEXT_TOKEN = re.compile(r"\*(user_id|item_id|item_text)\*")


def text_pieces(template: str) -> list[tuple[str, int | None]] | None:
    """A text template as data: ``(text, None)`` or ``('', k)``, the k-th of ``TEXT_PLACEHOLDERS``, in order.

    ``*user_genres*`` stays text (the genre step replaces it later). None if
    a ``*`` outside the placeholders could take part in a match of the
    sequential replacement; only then putting the pieces together isn't provably the same.
    """
    pieces, pos = [], 0
    for m in _TEXT_TOKEN.finditer(template):
        pieces += [(template[pos:m.start()], None), ("", TEXT_PLACEHOLDERS.index(m.group(1)))]
        pos = m.end()
    pieces.append((template[pos:], None))
    if any("*" in text.replace("*user_genres*", "") for text, _ in pieces):
        return None
    return [p for p in pieces if p != ("", None)]


def render_pieces(pieces: Column, template: Column, cold_start=(COLD_START_PHRASE, COLD_START_REPLACEMENT)) -> Column:
    """F8 for a template given as pieces: one higher-order expression, whatever the template, plus the genre step.

    Same result as the sequential replacement: the ids contain no ``*``, the
    template has no ``*`` outside its placeholders, and the item text is the
    last value inserted before the genre step, which still scans the whole
    string (so a ``*user_genres*`` inside an item text is replaced too). A template
    without pieces is rendered by nested replacement.
    """
    values = F.array(*[_text_of(name) for name in TEXT_PLACEHOLDERS])
    joined = F.array_join(F.transform(pieces, lambda p: F.coalesce(F.get(values, p["place"]), p["text"])), "")
    return F.when(pieces.isNull(), render(template, TEXT_PLACEHOLDERS, cold_start)).otherwise(_genre_step(joined, cold_start))


def value_pieces(template: str, placeholders: Sequence[str]) -> list[tuple[str, int | None]] | None:
    """A template as data, with places for every value: the k-th of ``placeholders``, the user's genres after the last.

    None if a ``*`` stands outside the placeholders, or nothing but letters a placeholder's
    name could have lies between two of them: only where neither holds can no ``*`` of
    two placeholders be taken for one placeholder at any step of the replacement.
    """
    names = [*placeholders, "user_genres"]
    pieces, pos = [], 0
    for m in re.finditer(rf"\*({'|'.join(names)})\*", template):
        pieces += [(template[pos:m.start()], None), ("", names.index(m.group(1)))]
        pos = m.end()
    pieces.append((template[pos:], None))
    texts = [text for text, place in pieces if place is None]
    if any("*" in text for text in texts) or any(re.fullmatch("[a-z_]*", text) for text in texts[1:-1]):
        return None
    return [p for p in pieces if p != ("", None)]


def template_values(kind: str) -> tuple[Column, Column, Column]:
    """What the prompts of a row share: its values, whether they are plain, and whether the genres go to their place at once.

    Plain values can't take part in a match of a later step, which begins and ends with a ``*``: structured
    ones have none; of the item text, the last value before the genres, only ``*user_genres*``
    matters, inside it or across one of its ends. After the values of the placeholders come what stands at
    ``*user_genres*`` before the genre step, then the genres if that step is still to be made.
    """
    names = TEXT_PLACEHOLDERS if kind == "text" else STRUCTURED_PLACEHOLDERS
    strings, genres = [_text_of(name) for name in names], _text_of("user_genres")
    if kind == "structured":
        plain = ~F.contains(F.concat(*strings), F.lit("*"))
    else:
        text, star = _text_of("item_text"), F.lit("*")
        ends = F.contains(F.substring(text, 1, 12), star) | F.contains(F.substring(text, -12, 12), star)
        plain = ~(ends | _has(text, "*user_genres*"))
    at_once = plain & (genres != "")
    values = F.array(*strings, F.when(at_once, genres).otherwise("*user_genres*"), F.when(at_once, "").otherwise(genres))
    return values, plain, at_once


def _has(text: Column, literal: str) -> Column:
    """``contains`` as a regular expression, whose search for a literal steps by its length."""
    return text.rlike(re.sub(r"([^A-Za-z0-9])", r"\\\1", literal))


def render_values(pieces: Column, template: Column, values: Column, plain: Column, at_once: Column, kind: str,
                  cold_start: tuple[str, str] = (COLD_START_PHRASE, COLD_START_REPLACEMENT)) -> Column:
    """F8/F9 for ``value_pieces`` of a template and ``template_values`` of a row: long strings are copied, not searched.

    The whole prompt is searched only for a user without genres or an item text with
    something like ``*user_genres*``; nested replacement is left for templates without pieces and
    structured values with a ``*``. The result is that of the sequential replacement.
    """
    names = TEXT_PLACEHOLDERS if kind == "text" else STRUCTURED_PLACEHOLDERS
    genres = F.when(at_once, F.get(values, F.lit(len(names)))).otherwise(F.get(values, F.lit(len(names) + 1)))
    joined = F.concat_ws("", F.transform(pieces, lambda p: F.coalesce(F.get(values, p["place"]), p["text"])))
    nested = template
    for k, name in enumerate(names):
        nested = F.replace(nested, F.lit(f"*{name}*"), F.get(values, F.lit(k)))
    phrase, replacement = cold_start
    searched = F.when(genres != "", F.replace(joined, F.lit("*user_genres*"), genres)).when(
        _has(joined, phrase), F.replace(joined, F.lit(phrase), F.lit(replacement))).otherwise(joined)
    by_nesting = pieces.isNull() if kind == "text" else pieces.isNull() | ~plain
    return F.when(by_nesting, _genre_step(nested, cold_start, genres)).when(at_once, joined).otherwise(searched)


def render_text(template: Column, **kw) -> Column:
    """F8: placeholders user_id, item_id, item_text (+ user_genres)."""
    return render(template, TEXT_PLACEHOLDERS, **kw)


def render_structured(template: Column, **kw) -> Column:
    """user_id, item_id and the five item features (+ user_genres)."""
    return render(template, STRUCTURED_PLACEHOLDERS, **kw)


def parse_mapping(mapping: str) -> dict[int, str]:
    """Parse a label-word mapping such as ``{0:'No', 1:'Yes'}`` (never eval)."""
    parsed = ast.literal_eval(mapping)
    if not isinstance(parsed, dict):
        raise ValueError(f"label mapping is not a dict: {mapping!r}")
    return {int(k): str(v) for k, v in parsed.items()}


def label_word(label: Column, word_neg: Column, word_pos: Column) -> Column:
    """1 -> positive word, 0 -> negative word, anything else NULL."""
    return F.when(label == 1, word_pos).when(label == 0, word_neg)
