"""C14 answer accuracy (F12, F13, A6) and the task registry."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.text import clean_prediction


def exact_match(pred_word: Column, label_word_col: Column) -> Column:
    """F13 as 0/1; a missing side counts as a mismatch."""
    return F.coalesce(pred_word == label_word_col, F.lit(False)).cast("double")


def accuracy(pred_word: Column, label_word_col: Column) -> Column:
    """Mean exact match, an aggregate Column."""
    return F.avg(exact_match(pred_word, label_word_col))


def answer_accuracy(
    answers: DataFrame,
    pred_col: str = "pred_raw",
    label_col: str = "label_word",
    group_cols: Sequence[str] = (),
) -> DataFrame:
    """C14: clean decoded generations and compare with the label words."""
    pred = clean_prediction(F.col(pred_col))
    return answers.groupBy(*group_cols).agg(accuracy(pred, F.col(label_col)).alias("acc"))


@dataclass(frozen=True)
class TaskSpec:
    """What the original registry said about a task."""

    name: str
    num_labels: int
    output_mode: str
    labels: tuple
    metric: Callable[[Column, Column], Column]


TASKS = {
    "dbbook": TaskSpec("dbbook", 2, "classification", (0, 1), accuracy),
    "dbbook_ranking": TaskSpec("dbbook_ranking", 2, "classification", (0, 1), accuracy),
}


def get_task(name: str) -> TaskSpec:
    try:
        return TASKS[name]
    except KeyError:
        raise ValueError(f"Task not found: {name}") from None


def task_accuracy(answers: DataFrame, task_name: str, group_cols: Sequence[str] = ("run_name",)) -> DataFrame:
    """Metric of ``task_name`` per group (per run by default)."""
    metric = get_task(task_name).metric
    pred = clean_prediction(F.col("pred_raw"))
    return answers.groupBy(*group_cols).agg(metric(pred, F.col("label_word")).alias("acc"))
