"""Knowledge-graph value cleaning (literal, not regex, matching)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.fixed_values import CATEGORY_MARKER, GENRE_SUFFIX, RESOURCE_PREFIX


def _after_first(col: Column, marker: str) -> Column:
    """Text between the first and second occurrence of ``marker``.

    NULL when the marker is absent, like indexing ``[1]`` of a string split
    that produced a single piece.
    """
    return F.when(
        F.instr(col, marker) > 0, F.split_part(col, F.lit(marker), F.lit(2))
    )


def strip_resource(col: Column) -> Column:
    """drop the resource prefix; NULL if the URI lacks it."""
    return _after_first(col, RESOURCE_PREFIX)


def clean_genre(col: Column) -> Column:
    """F1 + F2: strip the prefix, then remove every literal ``_(genre)``."""
    return F.replace(strip_resource(col), F.lit(GENRE_SUFFIX), F.lit(""))


def clean_subject(col: Column) -> Column:
    """F1 + F3: strip the prefix, then keep what follows ``Category:``.

    NULL when either marker is missing (such an element is skipped).
    """
    return _after_first(strip_resource(col), CATEGORY_MARKER)
