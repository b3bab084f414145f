"""Query registry: name -> (spark, sf_dir) -> DataFrame.

Every call builds its own ``RecPlan``, so a query sees its input as it is then.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwise.plans import file_queries
from shelfwise.plans.recplan import RecPlan


def plan_for(spark: SparkSession, sf_dir: str) -> RecPlan:
    return RecPlan(spark, sf_dir)


def _attr(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(plan_for(spark, sf_dir), name)

    run.__name__ = name
    return run


def _split(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plan_for(spark, sf_dir).examples_split(name)

    run.__name__ = f"examples_{name}"
    return run


def _skew_safe(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """The same result by joins that deal hot keys in pieces, over stored stages."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(RecPlan(spark, sf_dir, materialize=True, skew_safe=True), name)

    run.__name__ = f"{name}_skew_safe"
    return run


def _views(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(plan_for(spark, sf_dir).views, name)

    run.__name__ = name
    return run


QUERY_NAMES = (
    "item_features", "item_first_publisher", "item_subjects", "split_assignment",
    "split_counts_by_user", "user_profiles", "truncated_texts", "text_examples",
    "structured_examples", "ranking_candidates_text", "ranking_candidates_structured",
    "prompts_text_multi", "prompts_structured", "ranking_prompts_text",
    "ranking_prompts_structured", "ranked_predictions", "scored_ranking",
    "scored_ranking_structured", "answer_accuracy", "task_registry_accuracy",
    "ground_truth_text", "ground_truth_structured", "train_positives",
    "evaluable_predictions", "dropped_users", "evaluable_predictions_all_runs", "user_candidates",
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {n: _attr(n) for n in QUERY_NAMES}
    for s in ("train", "dev", "test"):
        out[f"examples_{s}"] = _split(s)
    for name in ("item_features", "text_examples", "structured_examples"):
        out[f"{name}_skew_safe"] = _skew_safe(name)
    out["mapping_entities"] = _views("mapping_entities")
    # Byte-pair encoding isn't in SQL: held against an independent encoder in the tests.
    out["truncated_texts_subword"] = _attr("truncated_texts_subword")
    return out | {f.__name__: f for f in file_queries.QUERIES}
