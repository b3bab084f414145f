"""Prompts for many runs at once (J9 + F8-F11).

A run is (run_name, kind, template, word_neg, word_pos). Runs are data, a one-row
table with an array of them, each template parsed once into its pieces; so
the plan is the same for one run and for thousands. The fan-out is an
``explode`` of that array (a scalar subquery): a generator in the same stage as the
rows it multiplies, no join and no shuffle. A prompt is rendered after the
fan-out, one at a time, so a row never holds the prompts of all runs.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.fixed_values import COLD_START_PHRASE, COLD_START_REPLACEMENT, PROMPT_RUNS, STRUCTURED_PLACEHOLDERS, TEXT_PLACEHOLDERS
from shelfwise.functions.prompt import label_word, parse_mapping, render_values, template_values, value_pieces

COLD_START = (COLD_START_PHRASE, COLD_START_REPLACEMENT)
_RUNS = pa.schema([("runs", pa.list_(pa.struct([
    ("run_index", pa.int32()), ("run_name", pa.string()), ("template", pa.string()),
    ("pieces", pa.list_(pa.struct([("text", pa.string()), ("place", pa.int32())]))), ("word_neg", pa.string()), ("word_pos", pa.string())])))])


@dataclass(frozen=True)
class PromptRun:
    run_name: str
    kind: str  # 'text' or 'structured'
    template: str
    word_neg: str
    word_pos: str

    @classmethod
    def from_mapping(cls, run_name: str, kind: str, template: str, mapping: str) -> PromptRun:
        words = parse_mapping(mapping)
        return cls(run_name, kind, template, words.get(0), words.get(1))


def default_runs(kind: str | None = None) -> list[PromptRun]:
    """The eight published runs (six text, two structured)."""
    runs = [PromptRun.from_mapping(*r) for r in PROMPT_RUNS]
    return [r for r in runs if kind is None or r.kind == kind]


def with_runs(df: DataFrame, runs: Iterable[PromptRun], index_col: str | None = None) -> DataFrame:
    """One output row per (input row, run); adds the run columns."""
    runs = list(runs)
    if not runs:
        raise ValueError("no prompt runs given")
    rows = [{"run_index": i, "run_name": r.run_name, "template": r.template, "pieces": _pieces(r), "word_neg": r.word_neg,
             "word_pos": r.word_pos} for i, r in enumerate(runs)]
    table = df.sparkSession.createDataFrame(pa.Table.from_pylist([{"runs": rows}], _RUNS))
    out = df.select("*", table.scalar().alias("_runs")).select(*df.columns, F.explode("_runs").alias("_run"))
    out = out.select(*df.columns, *[F.col(f"_run.{c}").alias(c) for c in ("run_index", "run_name", "template", "pieces", "word_neg", "word_pos")])
    return out if index_col is None else out.withColumnRenamed("run_index", index_col)


def _pieces(run: PromptRun) -> list[dict] | None:
    pieces = value_pieces(run.template, _placeholders(run.kind))
    return pieces and [{"text": text, "place": place} for text, place in pieces]


def _placeholders(kind: str) -> tuple[str, ...]:
    return TEXT_PLACEHOLDERS if kind == "text" else STRUCTURED_PLACEHOLDERS


def _with_prompts(df: DataFrame, runs: list[PromptRun], cold_start: tuple[str, str]) -> DataFrame:
    """J9 + F8/F9: one row per (input row, run) carrying its rendered prompt.

    What a row's prompts share is made once, before the fan-out: its values as strings, and whether any
    of them could be taken for a placeholder.
    """
    kinds = {r.kind for r in runs}
    if not kinds <= {"text", "structured"} or len(kinds) != 1:
        raise ValueError(f"prompt runs of one kind, text or structured, are needed, not {sorted(kinds)}")
    kind, names = runs[0].kind, _placeholders(runs[0].kind)
    rest = [c for c in df.columns if c in ("user_id", "item_id") or c not in (*names, "user_genres")]
    shared = ("_values", "_plain", "_at_once")
    rows = df.select(*rest, *[c.alias(name) for c, name in zip(template_values(kind), shared)])
    fan = with_runs(rows, runs, index_col="_run_index")
    prompt = render_values(F.col("pieces"), F.col("template"), *[F.col(c) for c in shared], kind, cold_start)
    return fan.withColumn("prompt", prompt).drop("_run_index", "template", "pieces", *shared)


def training_prompts(examples: DataFrame, runs: Iterable[PromptRun], kind: str,
                     cold_start: tuple[str, str] = COLD_START) -> DataFrame:
    """``run_name[, split], user_id, item_id, label, prompt, label_word``."""
    runs = [r for r in runs if r.kind == kind]
    extra = ["split"] if "split" in examples.columns else []
    fan = _with_prompts(examples, runs, cold_start)
    return fan.select(
        "run_name", *extra, "user_id", "item_id", "label", "prompt",
        label_word(F.col("label"), F.col("word_neg"), F.col("word_pos")).alias("label_word"),
    )


def ranking_prompts(candidates: DataFrame, runs: Iterable[PromptRun], kind: str,
                    cold_start: tuple[str, str] = COLD_START) -> DataFrame:
    """``run_name, user_id, item_id, prompt, word_pos[, seq]`` (no label)."""
    runs = [r for r in runs if r.kind == kind]
    extra = ["seq"] if "seq" in candidates.columns else []
    fan = _with_prompts(candidates, runs, cold_start)
    return fan.select("run_name", "user_id", "item_id", "prompt", "word_pos", *extra)
