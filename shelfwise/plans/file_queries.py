"""Queries whose data go through the original's files: written as TSV, read back, and used from there.

Each query derives its input from the driver tables, writes it with the sinks to
the shared folder, reads it with the sources and returns what the operators make
of it, so that sinks and sources are held against the same SQL as the plain plan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.operators import features, scoring
from shelfwise.operators.ranking import rank_within_groups
from shelfwise.plans import stages
from shelfwise.plans.recplan import RecPlan
from shelfwise.session import checkpoint_dir
from shelfwise.sources import tsv

_ROW_OF_PARTITION = (1 << 33) - 1


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/shelfwise-{name}-{uuid.uuid4().hex}"


def _with_header(lines: DataFrame, header: tuple[str, ...]) -> DataFrame:
    """``line`` with the header lines before the first row of each partition, that is of each file written."""
    first = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_OF_PARTITION)) == 0
    both = F.when(first, F.array(*[F.lit(h) for h in header], "line")).otherwise(F.array("line"))
    return lines.select(F.explode(both).alias("value"))


def _entity_file(spark: SparkSession, plan: RecPlan) -> str:
    """The entity file of the original, two lines of header above the entities in their order."""
    path = f"{_folder(spark, 'raw')}/mapping_entities.tsv"
    ordered = plan.views.mapping_entities.repartitionByRange("id").sortWithinPartitions("id")
    lines = ordered.select(F.concat(F.col("id").cast("string"), F.lit("\t"), "prop").alias("line"))
    _with_header(lines, ("id\tprop", "0\thttp://dbpedia.org/resource/skipped")).write.text(path)
    return path


def entities_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: ``id, prop, place``; the place in the file, counted from the lines' numbers."""
    entities = tsv.read_entities(spark, _entity_file(spark, RecPlan(spark, sf_dir)))
    return rank_within_groups(entities, [], ["seq"], rank_col="place").select("id", "prop", "place")


def item_features_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the triple and entity files, themselves written and read."""
    plan = RecPlan(spark, sf_dir)
    base = _folder(spark, "interim")
    tsv.write_tsv(plan.views.item_prop, f"{base}/item-prop.tsv")
    made = features.item_features(tsv.read_item_prop(spark, f"{base}/item-prop.tsv"), tsv.read_entities(spark, _entity_file(spark, plan)),
                                  entity_order="seq", triple_order="seq")
    tsv.write_tsv(made, f"{base}/features.tsv")
    return tsv.read_item_features(spark, f"{base}/features.tsv")


def quoted_features_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features that hold line breaks, separators and quotes come back whole."""
    path = f"{_folder(spark, 'interim')}/features.tsv"
    made = RecPlan(spark, sf_dir).item_features
    broken = made.select(
        "item_id", F.concat("author", F.lit('\n"by" '), "publisher").alias("author"), F.concat(F.lit('"'), "genre", F.lit('"')).alias("genre"),
        F.concat("series", F.lit("\t\n\n"), "genre").alias("series"), "publisher",
        F.when(F.col("item_id") % 5 == 0, "NA").otherwise(F.replace("subject", F.lit(","), F.lit(',\n'))).alias("subject"))
    tsv.write_tsv(broken, path)
    return tsv.read_item_features(spark, path)


def examples_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw logs to interim and processed splits, all through files."""
    plan = RecPlan(spark, sf_dir)
    data = _folder(spark, "data")
    tsv.write_tsv(plan.views.raw_train, f"{data}/raw/dbbook/train.tsv")
    tsv.write_tsv(plan.views.raw_test, f"{data}/raw/dbbook/test.tsv")
    tsv.write_tsv(plan.item_features, f"{data}/interim/dbbook/item-prop/train.tsv")
    stages.train_dev_split(spark, data)
    stages.build_user_profiles(spark, data)
    parts = [tsv.read_examples(spark, f"{data}/processed/dbbook/examples/split={s}").withColumn("split", F.lit(s)) for s in ("train", "dev", "test")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).na.fill("")


def predictions_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs' rankings written per run; the rank is the order of the lines."""
    path = _folder(spark, "results")
    ranked = RecPlan(spark, sf_dir).views.predictions.select("user_id", "item_id", "rank")
    sizes = ranked.groupBy("user_id").agg(F.max("rank").alias("n"))
    worst_first = ranked.join(sizes, "user_id").select("user_id", "item_id", (F.col("n") + 1 - F.col("rank")).alias("rank"))
    runs = ranked.withColumn("run_name", F.lit("best first")).unionByName(worst_first.withColumn("run_name", F.lit("worst:first")))
    tsv.write_ranked_predictions(runs, path)
    return tsv.read_predictions(spark, f"{path}/run_name=*")


def latest_scores_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log with several scores of a candidate, read from files; the last line wins, then ranked per user."""
    plan = RecPlan(spark, sf_dir)
    path = f"{_folder(spark, 'scores')}/scores.tsv"
    lines, orders = plan.views.table("lineitem"), plan.views.table("orders")
    log = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"),
        (((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13) % 1000).cast("double") / 1000).alias("score"), "l_orderkey", "l_linenumber")
    order = ["l_orderkey", "l_linenumber"]
    tsv.write_tsv(log.repartitionByRange(*order).sortWithinPartitions(*order).drop(*order), path)
    scores = tsv.read_table(spark, path, schemas.SCORE_LOG, required=schemas.SCORE_LOG.names, with_seq=True)
    latest = scoring.latest_scores(scores, keys=("user_id", "item_id"))
    return scoring.rank_scores(latest, ["user_id"]).select("user_id", "item_id", "score", "rank")


def ground_truth_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C15, K1, S7."""
    path = f"{_folder(spark, 'eval')}/test.tsv"
    tsv.write_tsv(RecPlan(spark, sf_dir).ground_truth_text, path)
    return tsv.read_ground_truth(spark, path)


QUERIES = (entities_from_files, item_features_from_files, quoted_features_from_files, examples_from_files, predictions_from_files,
           latest_scores_from_files, ground_truth_from_files)
