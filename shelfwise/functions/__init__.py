"""Scalar Column builders (all JVM-side, no Python UDF)."""

from shelfwise.functions.prompt import (
    label_word,
    parse_mapping,
    render_pieces,
    render_structured,
    render_text,
    text_pieces,
)
from shelfwise.functions.text import (
    clean_prediction,
    file_stem,
    na_to_null,
    run_name_from_path,
    strip_ws,
    truncate_words,
)
from shelfwise.functions.uri import clean_genre, clean_subject, strip_resource

__all__ = [
    "clean_genre", "clean_prediction", "clean_subject", "file_stem", "label_word",
    "na_to_null", "parse_mapping", "render_pieces", "render_structured", "render_text",
    "run_name_from_path", "strip_resource", "strip_ws", "text_pieces", "truncate_words",
]
