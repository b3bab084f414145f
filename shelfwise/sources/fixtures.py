"""Inputs of the recommendation pipeline derived from the driver tables.

The original pipeline reads a rating log, a triple file, an entity file and a
folder of item texts. Here those inputs are views over the TPC-H-like driver
tables, defined once in FIXTURES.md and written below as DataFrame code:

* interactions: one row per (customer, part) bought; label 0 if any line of it
  was returned, else 1;
* raw_train / raw_test: a deterministic partition of *all* interactions (every
  row lands in exactly one of the two; the arithmetic on the ids is the split
  rule of the fixture, not a sample);
* entity_src / mapping_entities / item_prop: knowledge-graph triples built from
  part and supplier attributes, some deliberately missing (the modulo tests
  create items without author, genre or series);
* texts: document text per item; scores / predictions / answers: deterministic
  stand-ins for model output.

Every view scales with the driver tables; nothing is sampled or capped.
Interactions, entities and triples are files in the original, read by most of its
steps; here they are written once to the shared folder when they are first used, so
that the fact table is scanned twice however many plans need them.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.fixed_values import CATEGORY_MARKER, RESOURCE_PREFIX
from shelfwise.operators.ranking import rank_within_groups
from shelfwise.session import materialize
from shelfwise.sources.tables import read_table

#: Rows that a task gets of what is dealt by a number of tasks that follows the table's length.
ROWS_A_TASK = 500_000


def build_interactions(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    li = lineitem.select(
        "l_orderkey",
        "l_partkey",
        F.when(F.col("l_returnflag") == "R", F.lit(0)).otherwise(F.lit(1)).alias("_lab"),
    )
    o = orders.select("o_orderkey", "o_custkey")
    joined = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    return joined.groupBy(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id")
    ).agg(F.max("_lab").alias("label"))


def _train_rule() -> F.Column:
    u, i = F.col("user_id"), F.col("item_id")
    return ((u * 7 + i * 13) % 10 < 8) & (u % 20 != 0)


def build_entity_src(part: DataFrame, lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    """Distinct (item_id, type, prop) triples before entity numbering.

    The six part-derived properties come from one scan of ``part``: each row
    generates its candidate triples with ``explode`` and absent ones (modulo
    rule of the fixture) are dropped, instead of scanning ``part`` six times.
    """
    p = part.select("p_partkey", "p_brand", "p_type", "p_name", "p_size")
    key = F.col("p_partkey")

    def res(*parts: F.Column) -> F.Column:
        return F.concat(F.lit(RESOURCE_PREFIX), *parts)

    def word(n: int) -> F.Column:
        return F.split_part(F.col("p_name"), F.lit(" "), F.lit(n))

    candidates = [
        (2, key % 11 != 0, res(F.col("p_brand"))),
        (4, key % 7 != 0, res(F.col("p_type"), F.lit("_(genre)"))),
        (3, key % 13 != 0, res(F.col("p_name"))),
        (7, F.lit(True), res(F.lit(CATEGORY_MARKER), word(1))),
        (7, F.lit(True), res(F.lit(CATEGORY_MARKER), word(2))),
        (6, F.lit(True), res(F.lit("size_"), F.col("p_size").cast("string"))),
    ]
    gen = F.array(*[
        F.struct(F.lit(code).alias("type"), F.when(keep, prop).alias("prop"), keep.alias("keep"))
        for code, keep, prop in candidates
    ])
    from_part = (
        p.select(key.alias("item_id"), F.explode(gen).alias("t"))
        .where(F.col("t.keep"))
        .select("item_id", F.col("t.type").alias("type"), F.col("t.prop").alias("prop"))
    )
    # Publisher: one entity per supplier of the part. Reduce lineitem to its
    # distinct (part, supplier) pairs first. They are nearly as many as the lines, so
    # both distincts are dealt to tasks whose number follows the lines: a task's
    # hash tables stay the same size however long the table is.
    tasks = _tasks(lineitem)
    pairs = lineitem.select("l_partkey", "l_suppkey").repartition(tasks, "l_partkey", "l_suppkey").distinct()
    sup = supplier.select("s_suppkey", "s_name")
    publisher = pairs.join(sup, pairs["l_suppkey"] == sup["s_suppkey"]).select(
        F.col("l_partkey").alias("item_id"), F.lit(5).alias("type"), res(F.col("s_name")).alias("prop")
    )
    return from_part.unionByName(publisher).repartition(tasks, "item_id", "type", "prop").distinct()


def _tasks(df: DataFrame) -> int:
    """How many tasks take ``ROWS_A_TASK`` rows of ``df`` each, but no fewer than a shuffle has (the count comes from the files' footers)."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS_A_TASK))


def build_mapping_entities(entity_src: DataFrame) -> DataFrame:
    """Distinct URIs numbered 1..n in md5 order (distributed row numbering, which reads its input several times)."""
    props = materialize(entity_src.select("prop").distinct(), "entities")
    ranked = rank_within_groups(props, [], [F.md5(F.col("prop")), F.col("prop")], rank_col="id")
    return ranked.select(F.col("id").cast("long").alias("id"), "prop")


class FixtureViews:
    """The views of one scale-factor folder, each made when it is first used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @cached_property
    def interactions(self) -> DataFrame:
        return materialize(build_interactions(self.table("lineitem"), self.table("orders")), "interactions")

    @cached_property
    def raw_train(self) -> DataFrame:
        return self.interactions.where(_train_rule())

    @cached_property
    def raw_test(self) -> DataFrame:
        return self.interactions.where(~_train_rule())

    @cached_property
    def entity_src(self) -> DataFrame:
        return materialize(build_entity_src(self.table("part"), self.table("lineitem"), self.table("supplier")), "triples")

    @cached_property
    def mapping_entities(self) -> DataFrame:
        return materialize(build_mapping_entities(self.entity_src), "mapping_entities")

    def numbered_triples(self) -> DataFrame:
        """The rows of ``item_prop``, not stored: one step alone reads them faster than it writes and reads a copy."""
        return self.entity_src.join(self.mapping_entities, "prop").select("item_id", "id", "type")

    @cached_property
    def item_prop(self) -> DataFrame:
        return materialize(self.numbered_triples(), "item_prop")

    @cached_property
    def texts(self) -> DataFrame:
        return self.table("documents").select(
            F.col("doc_id").alias("item_id"), F.col("text").alias("item_text")
        )

    @cached_property
    def scores(self) -> DataFrame:
        t = self.raw_test
        score = ((F.col("user_id") * 31 + F.col("item_id") * 17) % 1000).cast("double") / 1000
        return t.select("user_id", "item_id", score.alias("score"))

    @cached_property
    def predictions(self) -> DataFrame:
        return rank_within_groups(
            materialize(self.scores, "scores"), ["user_id"], [-F.col("score"), "item_id"], rank_col="rank"
        )

    @cached_property
    def answers(self) -> DataFrame:
        t = self.raw_test
        h = (F.col("user_id") * 31 + F.col("item_id") * 17) % 1000
        return t.select(
            "user_id",
            "item_id",
            F.concat(F.lit("<pad> "), F.when(h < 600, "Yes").otherwise("No"), F.lit("</s>")).alias("pred_raw"),
            F.when(F.col("label") == 1, "Yes").otherwise("No").alias("label_word"),
        )


def build_run_answers(raw_test: DataFrame, runs) -> DataFrame:
    """Decoded generations per run, a deterministic stand-in for a model.

    For run number k: the positive word when
    ``(user_id * 31 + item_id * 17 + 97 * k) mod 1000 < 600``, else the
    negative one, wrapped as ``<pad> word</s>``; the label word comes from the
    run's own mapping.
    """
    from shelfwise.functions.prompt import label_word
    from shelfwise.operators.prompts import with_runs

    fan = with_runs(raw_test.select("user_id", "item_id", "label"), runs, index_col="k")
    h = (F.col("user_id") * 31 + F.col("item_id") * 17 + F.col("k") * 97) % 1000
    word = F.when(h < 600, F.col("word_pos")).otherwise(F.col("word_neg"))
    return fan.select(
        "run_name",
        "user_id",
        "item_id",
        F.concat(F.lit("<pad> "), word, F.lit("</s>")).alias("pred_raw"),
        label_word(F.col("label"), F.col("word_neg"), F.col("word_pos")).alias("label_word"),
    )
