"""Ground truth and evaluable predictions for ranking evaluation.

* positives (P4): ``label`` not equal to 0, NULL-safe: a missing label passes,
  as ``NaN != 0`` does in pandas;
* text ground truth (C15): test positives whose item has a non-empty *raw*
  text; structured (C16): test positives whose item is complete;
* evaluable predictions (C17/C18, J8): predictions of users present in the
  ground truth, as a left-semi join (no set is collected anywhere);
* dropped users (U2): the complement, as a left-anti join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.examples import complete_features, non_empty_texts


def positives(interactions: DataFrame) -> DataFrame:
    return interactions.where(~F.col("label").eqNullSafe(0)).select("user_id", "item_id", "label")


def ground_truth_text(test: DataFrame, raw_texts: DataFrame) -> DataFrame:
    items = non_empty_texts(raw_texts).select("item_id")
    return positives(test).join(items, "item_id", "left_semi").select("user_id", "item_id", "label")


def ground_truth_structured(test: DataFrame, item_features: DataFrame) -> DataFrame:
    items = complete_features(item_features).select("item_id")
    return positives(test).join(items, "item_id", "left_semi").select("user_id", "item_id", "label")


def evaluable_predictions(predictions: DataFrame, truth: DataFrame, on=("user_id",)) -> DataFrame:
    """Keep predictions whose ``on`` key occurs in ``truth``."""
    keys = list(on)
    return predictions.join(truth.select(*keys).distinct(), keys, "left_semi")


def dropped_users(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """Users with predictions but no ground truth."""
    return (
        predictions.select("user_id").distinct()
        .join(truth.select("user_id").distinct(), "user_id", "left_anti")
    )


def evaluable_predictions_by_kind(ranked: DataFrame, truths: dict[str, DataFrame]) -> DataFrame:
    """``ranked`` carries ``kind``; each kind is filtered by its own truth.

    The truths are stacked with their kind and joined once on (kind, user).
    """
    stacked = None
    for kind, truth in truths.items():
        part = truth.select(F.lit(kind).alias("kind"), "user_id")
        stacked = part if stacked is None else stacked.unionByName(part)
    return ranked.join(stacked, ["kind", "user_id"], "left_semi")
