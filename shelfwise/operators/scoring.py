"""Batch scoring with a pluggable scorer (X1) and per-user ranking.

The scorer is the only Python in the hot path: it gets pandas batches of
``run_name, user_id, item_id, prompt, word_pos`` (an Arrow batch of
``spark.sql.execution.arrow.maxRecordsPerBatch`` rows, in pieces of ``BATCH_BYTES``) and gives one float per row,
the score of the run's positive answer word. Model state belongs in the
scorer object and is built lazily once per Python worker.

Ranking: score descending, ties by item id ascending, one rank 1..n per
(run, user), computed without gathering a user's candidates in one task. A candidate
that was scored several times counts with the score of its last source row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators.ranking import rank_within_groups
from shelfwise.session import materialize

SCORE_SCHEMA = "run_name string, user_id bigint, item_id bigint, score double"

Scorer = Callable[[pd.DataFrame], "pd.Series"]

#: Bytes of prompts that a scorer gets at once: what a Python worker holds follows from it, not from the length of the texts.
BATCH_BYTES = 1 << 20


class StubScorer:
    """Deterministic stand-in for a language model, used by tests and bench.

    score = ((user_id * 31 + item_id * 17 + len(prompt)) mod 1000) / 1000; it
    reads the rendered prompt, so the prompt is built and shipped as a real
    model would need it, and it produces ties.
    """

    def __call__(self, batch: pd.DataFrame) -> pd.Series:
        n = batch["prompt"].str.len().fillna(0).astype("int64")
        raw = (batch["user_id"].astype("int64") * 31 + batch["item_id"].astype("int64") * 17 + n) % 1000
        return raw.astype("float64") / 1000.0


def score_prompts(prompts: DataFrame, scorer: Scorer, balance_partitions: int | None = None) -> DataFrame:
    """Apply ``scorer`` to every prompt; returns ``run_name, user_id, item_id, score`` and ``seq`` if the prompts have one.

    ``seq`` (any sortable value, e.g. file and line of the source row) passes by the scorer
    and says which score of a repeated candidate is the last one.
    ``balance_partitions``: round-robin the prompts into that many partitions
    first, so an expensive model sees evenly sized tasks.
    """
    cols = ["run_name", "user_id", "item_id", "prompt", "word_pos"]
    parts = _seq_parts(prompts)
    src = prompts.select(*cols, *[c.alias(f"_seq_{n}") for n, c, _ in parts])
    if balance_partitions:
        src = src.repartition(int(balance_partitions))
    schema = T.StructType([*T.StructType.fromDDL(SCORE_SCHEMA).fields, *[T.StructField(f"_seq_{n}", t) for n, _, t in parts]])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _in_bytes(batch):
                score = pd.Series(list(scorer(rows.select(cols).to_pandas())), dtype="float64")
                if len(score) != len(rows):
                    raise ValueError(f"the scorer returned {len(score)} scores for {len(rows)} prompts")
                if score.isna().any():
                    raise ValueError("the scorer returned a missing score")
                keys = rows.drop_columns(["prompt", "word_pos"])
                yield keys.add_column(3, "score", pa.array(score, pa.float64()))
                del rows, keys, score
            del batch
            pa.default_memory_pool().release_unused()

    out = src.mapInArrow(apply, schema)
    if not parts:
        return out
    names = [F.col(f"_seq_{n}").alias(n) for n, _, _ in parts]
    return out.select("run_name", "user_id", "item_id", "score", (F.struct(*names) if len(parts) > 1 else names[0]).alias("seq"))


def _in_bytes(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces with some ``BATCH_BYTES`` of prompts each; a longer single prompt stands alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column("prompt")), 0).to_numpy(zero_copy_only=False).astype("int64")
    piece = (sizes.cumsum() - sizes) // BATCH_BYTES
    cuts = [0, *(piece[1:] != piece[:-1]).nonzero()[0] + 1, len(batch)]
    for start, end in zip(cuts, cuts[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def _seq_parts(prompts: DataFrame) -> list[tuple[str, Column, T.DataType]]:
    """The fields of ``seq`` as flat columns, which cross to Python without a struct per row."""
    if "seq" not in prompts.columns:
        return []
    kind = prompts.schema["seq"].dataType
    if isinstance(kind, T.StructType):
        return [(f.name, F.col(f"seq.`{f.name}`"), f.dataType) for f in kind.fields]
    return [("seq", F.col("seq"), kind)]


def score_new_prompts(prompts: DataFrame, scorer: Scorer, ledger: str, balance_partitions: int | None = None) -> DataFrame:
    """The scores of ``prompts``, of which only those are scored that the ledger doesn't hold.

    ``ledger`` is a folder of scored prompts, ``run_name, user_id, item_id`` and a
    128-bit digest of what the scorer saw, with its score. New scores are appended as one
    write, whose files count only when it is complete: a run that is stopped leaves
    nothing behind, one that is repeated scores nothing twice. Prompts are dealt out
    by length, so that the batches a model pads hold prompts of like length.
    """
    spark = prompts.sparkSession
    schema = T.StructType([*T.StructType.fromDDL(SCORE_SCHEMA).fields, T.StructField("seen", T.StringType())])
    seen = F.md5(F.concat_ws("\u0000", F.col("word_pos"), F.col("prompt"))).alias("seen")
    wanted = prompts.select("run_name", "user_id", "item_id", "prompt", "word_pos", seen)
    keys = ["run_name", "user_id", "item_id", "seen"]
    spark.createDataFrame([], schema).write.mode("append").parquet(ledger)
    known = spark.read.schema(schema).parquet(ledger)
    new = wanted.join(known.select(*keys), keys, "left_anti").dropDuplicates(keys)
    parts = balance_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = new.repartition(parts).sortWithinPartitions(F.length("prompt"))
    scored = score_prompts(dealt.withColumn("seq", F.col("seen")), scorer).withColumnRenamed("seq", "seen")
    scored.write.mode("append").parquet(ledger)
    return (wanted.select(*keys).distinct().join(spark.read.schema(schema).parquet(ledger), keys)
            .select("run_name", "user_id", "item_id", "score"))


def latest_scores(scores: DataFrame, seq_col: str = "seq", keys=("run_name", "user_id", "item_id")) -> DataFrame:
    """One score per candidate, the one that comes last in ``seq_col``.

    The order is carried in the rows, from their source, so the result is the same
    however they are partitioned. Of scores that share a place, or without
    ``seq_col``, the highest is taken.
    """
    if seq_col not in scores.columns:
        return scores.groupBy(*keys).agg(F.max("score").alias("score"))
    return scores.groupBy(*keys).agg(F.max(F.struct(F.col(seq_col), "score"))["score"].alias("score"))


def rank_scores(scores: DataFrame, group_cols=("run_name", "user_id")) -> DataFrame:
    """Adds ``rank`` (BIGINT) by score desc (NULL last), item_id asc within each group."""
    score = F.col("score")
    return rank_within_groups(scores, list(group_cols), [score.isNull(), -score, "item_id"], rank_col="rank")


def scored_ranking(
    prompts: DataFrame,
    scorer: Scorer,
    balance_partitions: int | None = None,
) -> DataFrame:
    """``run_name, user_id, item_id, score, rank``; a repeated candidate counts once, with its last score by ``seq``.

    Scores are stored before ranking: the model then runs exactly once per prompt.
    """
    scores = materialize(score_prompts(prompts, scorer, balance_partitions), "scores")
    return rank_scores(latest_scores(scores)).select("run_name", "user_id", "item_id", "score", "rank")
