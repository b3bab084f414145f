"""Corpus pipeline: toxicity, exact and near duplicates, decontamination, packing.

Each stage works on all that the one before it kept; its result is written as
Parquet to the shared folder and read again as the next stage's documents. The
last stage returns the packed pieces.

What NULL ids and texts, empty and very long texts, repeated rows, empty tables and
further columns give is said in ``shelfwise.llm.stages``, stage by stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import queries as _queries
from shelfwise.llm import stages as _stages
from shelfwise.llm.common import stored


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator doesn't reject; it learns from the labelled rows of the whole table."""
    labelled = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return _stages.drop_toxic(docs, labelled, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal without white space."""
    return _stages.drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash over three-word shingles at two bits or fewer."""
    return _stages.drop_near_duplicates(docs, words=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten words of a benchmark item (the whole item, if shorter)."""
    return _stages.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens in sequences of at most 4,096."""
    return _stages.pack(docs, _queries.tokenizer_path())


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The classifier and the tokenizer aren't in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
