"""Invariants of the split and the distributed ranking, plus plan checks."""

from pyspark.sql import functions as F

from shelfwise.operators import split
from shelfwise.operators.ranking import rank_within_groups, rank_within_groups_window
from shelfwise.plans.recplan import RecPlan
from shelfwise.sources.fixtures import build_interactions

SF = "/root/testdata/sf0.001"


def _hot_group_frame(spark):
    # user 0 holds a third of the rows; scores have ties
    hot = spark.range(0, 3000).select(F.lit(0).cast("long").alias("g"), F.col("id").alias("item"))
    rest = spark.range(0, 6000).select((F.col("id") % 500 + 1).alias("g"), F.col("id").alias("item"))
    nulls = spark.range(0, 40).select(F.lit(None).cast("long").alias("g"), (F.col("id") + 10**6).alias("item"))
    df = hot.unionByName(rest).unionByName(nulls)
    return df.withColumn("score", ((F.col("item") * 7919) % 101).cast("double"))


def test_skew_safe_rank_equals_window(spark):
    df = _hot_group_frame(spark)
    a = rank_within_groups(df, ["g"], [-F.col("score"), "item"], "rank", size_col="n")
    b = rank_within_groups_window(df, ["g"], [F.col("score").desc(), F.col("item")], "rank", size_col="n")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hot_group_spreads_over_partitions(spark):
    df = _hot_group_frame(spark)
    ranked = rank_within_groups(df, ["g"], [-F.col("score"), "item"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = [r["count"] for r in ranked.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        hot = [r["count"] for r in ranked.where("g = 0").groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(hot) == 8 and max(hot) < 3000 / 4 and max(tasks) < 2 * sum(tasks) / len(tasks)


def test_hot_tie_spreads_over_partitions(spark):
    # one score for all: the chunks are cut at the next key
    df = spark.range(20_000).select(F.lit(1).alias("g"), F.lit(0.5).alias("score"), "id")
    ranked = rank_within_groups(df, ["g"], [-F.col("score"), "id"])
    assert ranked.where(F.col("rank") != F.col("id") + 1).isEmpty()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert ranked.groupBy(F.spark_partition_id()).count().count() == 8
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_ranking_is_lazy_and_shuffles_rows_once(spark):
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup
    spark.sparkContext.setJobGroup("ranking-lazy", "")
    plan = rank_within_groups(_hot_group_frame(spark), ["g"], [-F.col("score"), "item"])._jdf.queryExecution().executedPlan().toString()
    assert not jobs("ranking-lazy")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    left = plan[plan.index("SortMergeJoin"):plan.index("Exchange hashpartitioning(_group", plan.index("row_number()"))]
    assert left.count("Exchange") == 0 and "Scan ExistingRDD" not in plan


def test_global_row_number(spark):
    df = spark.range(0, 1000).select((F.col("id") * 37 % 1000).alias("k"))
    r = rank_within_groups(df, [], ["k"], "rn", size_col="n")
    rows = r.collect()
    assert sorted(x["rn"] for x in rows) == list(range(1, 1001))
    assert all(x["rn"] == x["k"] + 1 and x["n"] == 1000 for x in rows)


def test_split_invariants(spark):
    plan = RecPlan(spark, SF)
    raw = plan.views.raw_train
    s = plan.split_assignment
    # train + dev is the raw train multiset
    assert s.drop("split").exceptAll(raw).count() == 0
    assert raw.exceptAll(s.drop("split")).count() == 0
    # per-user quota
    counts = split.split_counts_by_user(s)
    bad = counts.where(F.col("n_dev") != F.rint(F.lit(0.2) * F.col("n_rows")).cast("long"))
    assert bad.count() == 0


def test_split_independent_of_partitioning(spark):
    raw = RecPlan(spark, SF).views.raw_train
    a = split.assign_split(raw.repartition(3), 0.2, 42)
    b = split.assign_split(raw.repartition(11), 0.2, 42)
    assert a.exceptAll(b).count() == 0


def test_profile_genres_subset_of_train_positive_genres(spark):
    plan = RecPlan(spark, SF)
    prof = plan.user_profiles.select("user_id", F.explode(F.split("user_genres", ", ")).alias("g")).where("g != ''")
    pos = (
        plan.split_assignment.where("split = 'train' AND label = 1")
        .join(plan.item_features, "item_id")
        .select("user_id", F.col("genre").alias("g"))
    )
    assert prof.join(pos, ["user_id", "g"], "left_anti").count() == 0


def test_ranks_gapless_per_run_user(spark):
    ranked = RecPlan(spark, SF).scored_ranking
    agg = ranked.groupBy("run_name", "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("rank").alias("lo"), F.max("rank").alias("hi"),
        F.countDistinct("rank").alias("d"),
    )
    assert agg.where("lo != 1 OR hi != n OR d != n").count() == 0


def test_no_python_udf_outside_scorer(spark):
    plan = RecPlan(spark, SF)
    for df in (plan.examples, plan.prompts_text_multi, plan.item_features, plan.structured_examples):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "ArrowEval" not in text


def test_structured_join_is_inner_and_filter_pushed(spark):
    df = RecPlan(spark, SF).structured_examples
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    top_join = next(line for line in lines if "Join " in line)
    assert "Join Inner" in top_join
    # the completeness predicate runs on the feature side, below the join
    below = lines[lines.index(top_join):]
    assert any("Filter" in line and all(f"{c}#" in line for c in ("author", "series", "publisher", "subject")) for line in below)


def test_item_features_join_used_codes_only(spark):
    df = RecPlan(spark, SF).item_features
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not any("LeftOuter" in line for line in lines)
    assert any("Filter" in line and " IN (" in line for line in lines[next(i for i, x in enumerate(lines) if "Join Inner" in x):])


def test_parquet_scans_are_pruned(spark):
    views = RecPlan(spark, SF).views
    df = build_interactions(views.table("lineitem"), views.table("orders"))
    text = df._jdf.queryExecution().executedPlan().toString()
    # lineitem is read with three of its eleven columns only
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_returnflag:string>" in text


def test_examples_read_the_stored_views_only(spark):
    text = RecPlan(spark, SF).examples._jdf.queryExecution().executedPlan().toString()
    assert "l_partkey" not in text and "l_orderkey" not in text


def test_materialized_stages_match_lazy_plan(spark):
    lazy = RecPlan(spark, SF, materialize=False)
    stored = RecPlan(spark, SF, materialize=True)
    for name in ("item_features", "split_assignment", "examples", "text_examples"):
        a, b = getattr(lazy, name), getattr(stored, name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_rank_with_payload_columns_and_string_key(spark):
    # Columns that are neither group nor sort key pass through.
    df = _hot_group_frame(spark).select(
        F.concat_ws("|", F.lit("run"), F.col("g").cast("string")).alias("key"),
        "item", "score", (F.col("item") * 3).alias("payload"), F.lit("x").alias("note"),
    )
    a = rank_within_groups(df, ["key"], [-F.col("score"), "item"], "rank", size_col="n")
    b = rank_within_groups_window(df, ["key"], [F.col("score").desc(), F.col("item")], "rank", size_col="n")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rank_on_empty_input(spark):
    df = spark.createDataFrame([], "g long, k long")
    assert rank_within_groups(df, ["g"], ["k"], "rank", size_col="n").count() == 0
    assert rank_within_groups(df, [], ["k"], "rank", size_col="n").count() == 0


def test_split_with_hot_user_equals_window_split(spark):
    hot = spark.range(0, 3000).select(F.lit(7).cast("long").alias("user_id"), F.col("id").alias("item_id"))
    rest = spark.range(0, 6000).select((F.col("id") % 300 + 100).alias("user_id"), F.col("id").alias("item_id"))
    df = hot.unionByName(rest).withColumn("label", (F.col("item_id") % 3 != 0).cast("int"))
    a = split.assign_split(df, 0.2, 42, skew_safe=True)
    b = split.assign_split(df, 0.2, 42, skew_safe=False)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    hot_dev = a.where("user_id = 7 AND split = 'dev'").count()
    assert hot_dev == 600
