"""User taste profiles and the five-column examples of every split.

* profile (P3, J2, A4, A5): genres of the items a user rated positively in the
  *train* split only (no dev/test leakage), empty genres dropped, distinct,
  sorted (the original used a Python set, whose order is not reproducible),
  joined with ``', '``. ``collect_set`` is bounded by the number of genres and
  is partially aggregated map-side, so a hot user costs nothing extra;
* examples (J3, J2, P9, U3): every split row with its user's profile and the
  item's genre, missing values as ``''``. One plan for all three splits,
  tagged by a ``split`` column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.skew import Join, plain_join


def user_profiles(train_rows: DataFrame, item_features: DataFrame, join: Join = plain_join) -> DataFrame:
    """``user_id, user_genres`` for users with at least one positive train row."""
    positives = train_rows.where((F.col("label") == 1) & F.col("user_id").isNotNull()).select(
        "user_id", "item_id"
    )
    genres = item_features.select("item_id", "genre")
    liked = join(positives, genres, "item_id", "left")
    return liked.groupBy("user_id").agg(
        F.array_join(F.array_sort(F.collect_set(F.nullif(F.col("genre"), F.lit("")))), ", ").alias(
            "user_genres"
        )
    )


def tag_splits(split_rows: DataFrame, test_rows: DataFrame) -> DataFrame:
    """train/dev rows (with ``split``) plus the test rows tagged ``test``."""
    test = test_rows.select("user_id", "item_id", "label", F.lit("test").alias("split"))
    return split_rows.select("user_id", "item_id", "label", "split").unionByName(test)


def build_examples(rows: DataFrame, profiles: DataFrame, item_features: DataFrame, join: Join = plain_join) -> DataFrame:
    """``user_id, item_id, label, user_genres, item_genre, split``."""
    genres = item_features.select("item_id", F.col("genre").alias("_genre"))
    # one row a user: the first join leaves the items as often as they are in ``rows``
    joined = join(join(rows, profiles, "user_id", "left"), genres, "item_id", "left", like=rows)
    return joined.select(
        "user_id",
        "item_id",
        "label",
        F.coalesce(F.col("user_genres"), F.lit("")).alias("user_genres"),
        F.coalesce(F.col("_genre"), F.lit("")).alias("item_genre"),
        "split",
    )


def examples_of(examples: DataFrame, split: str) -> DataFrame:
    """One split as the original five columns (prunes by ``split``)."""
    return examples.where(F.col("split") == split).select(
        "user_id", "item_id", "label", "user_genres", "item_genre"
    )
