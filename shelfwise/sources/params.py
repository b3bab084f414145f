"""Experiment parameter files (one JSON object per run).

Used fields: ``template`` and ``mapping``. A run is named after its file (F14),
as its result file is; two files of one name are an error. The kind (text or
structured) follows from the placeholders the template uses. Runs are
configuration, so they are collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.fixed_values import STRUCTURED_PLACEHOLDERS, TEXT_PLACEHOLDERS
from shelfwise.functions.text import run_name_from_path
from shelfwise.operators.prompts import PromptRun

_STRUCTURED_ONLY = [p for p in STRUCTURED_PLACEHOLDERS if p not in TEXT_PLACEHOLDERS]


def read_run_table(spark: SparkSession, path: str) -> DataFrame:
    """``run_name, kind, template, mapping`` from a folder of JSON files."""
    raw = spark.read.option("multiLine", "true").json(path).withColumn(
        # a file path is URL-encoded; a plus sign in it is a plus sign
        "_path", F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    )
    structured = F.lit(False)
    for p in _STRUCTURED_ONLY:
        structured = structured | F.col("template").contains(f"*{p}*")
    return raw.select(
        run_name_from_path(F.col("_path")).alias("run_name"),
        F.when(structured, "structured").otherwise("text").alias("kind"),
        "template",
        "mapping",
    )


def read_prompt_runs(spark: SparkSession, path: str) -> list[PromptRun]:
    """Parameter files -> runs with parsed label words ."""
    rows = read_run_table(spark, path).collect()
    names = [r.run_name for r in rows]
    if len(set(names)) < len(names):
        raise ValueError(f"several parameter files are named {sorted({n for n in names if names.count(n) > 1})}")
    return [PromptRun.from_mapping(r.run_name, r.kind, r.template, r.mapping) for r in rows]
