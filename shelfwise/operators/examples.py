"""Text and structured examples, training and ranking variants.

* text (J5, P8): examples with the item's text; items without text or with an
  empty text are dropped. Texts are the widest table: they are pruned to two
  columns and filtered before the join, and joined last;
* structured (J4, P7, D17): examples whose item has all five features
  non-empty. Written as the inner join it is; the completeness predicate is
  pushed into the feature side by Catalyst;
* ranking candidates (C7, C8): the test split without label (and without
  item_genre for text), for every user at once instead of one user per pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.skew import Join, plain_join

FEATURE_RENAMES = (
    ("author", "item_author"),
    ("series", "item_series"),
    ("publisher", "item_publisher"),
    ("subject", "item_subject"),
)


def non_empty_texts(texts: DataFrame) -> DataFrame:
    return texts.select("item_id", "item_text").where(F.col("item_text") != "")


def complete_features(item_features: DataFrame) -> DataFrame:
    """Items whose five features are all non-empty, renamed ``item_*``."""
    cond = F.lit(True)
    for c in ("author", "genre", "series", "publisher", "subject"):
        cond = cond & (F.coalesce(F.col(c), F.lit("")) != "")
    return item_features.where(cond).select("item_id", *[F.col(a).alias(b) for a, b in FEATURE_RENAMES])


def _carried(examples: DataFrame) -> list[str]:
    """Columns that pass through where the examples have them: the split, and the place of the row in its source."""
    return [c for c in ("split", "seq") if c in examples.columns]


def text_examples(examples: DataFrame, texts: DataFrame, join: Join = plain_join) -> DataFrame:
    """``user_id, item_id, label, user_genres, item_genre, item_text[, split][, seq]``."""
    extra = _carried(examples)
    return join(examples, non_empty_texts(texts), "item_id", "inner").select(
        "user_id", "item_id", "label", "user_genres", "item_genre", "item_text", *extra
    )


def structured_examples(examples: DataFrame, item_features: DataFrame, join: Join = plain_join) -> DataFrame:
    """Examples of complete items with ``item_author/series/publisher/subject``."""
    extra = _carried(examples)
    ex = examples.where(F.col("item_genre") != "")
    return join(ex, complete_features(item_features), "item_id", "inner").select(
        "user_id", "item_id", "label", "user_genres", "item_genre",
        *[b for _, b in FEATURE_RENAMES], *extra,
    )


def ranking_candidates_text(test_examples: DataFrame, texts: DataFrame) -> DataFrame:
    """C7 for all users: ``user_id, item_id, user_genres, item_text``."""
    return text_examples(test_examples.drop("split"), texts).drop("label", "item_genre")


def ranking_candidates_structured(test_examples: DataFrame, item_features: DataFrame) -> DataFrame:
    """C8 for all users: structured examples of the test split without label."""
    return structured_examples(test_examples.drop("split"), item_features).drop("label")


def candidates_for_user(candidates: DataFrame, user_id: int | Column) -> DataFrame:
    """One user's candidates (the per-user API of the original); the user may come from a scalar subquery."""
    return candidates.where(F.col("user_id") == (user_id if isinstance(user_id, Column) else F.lit(user_id)))


def busiest_user(candidates: DataFrame) -> Column:
    """The user with the most candidates, of several the smallest id, as a scalar subquery."""
    counts = candidates.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max_by("user_id", F.struct("n", -F.col("user_id")))).scalar()
