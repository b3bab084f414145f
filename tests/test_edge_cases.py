"""Hand-made micro tables for the semantics that are easy to get wrong."""

from pyspark.sql import functions as F

from shelfwise.fixed_values import RESOURCE_PREFIX as R
from shelfwise.functions.text import clean_prediction, truncate_words
from shelfwise.operators import examples as ex
from shelfwise.operators import export, features, metrics, profiles, prompts, scoring, split
from shelfwise.operators.prompts import PromptRun
from shelfwise import schemas


def _features(spark, triples, entities):
    ip = spark.createDataFrame(triples, schemas.ITEM_PROP)
    ents = spark.createDataFrame(entities, schemas.ENTITIES)
    return {r["item_id"]: r.asDict() for r in features.item_features(ip, ents).collect()}


def test_item_features_first_value_and_subjects(spark):
    entities = [
        (1, R + "b"),                    # author b (entity order first)
        (2, R + "a"),                    # author a
        (3, R + "Fantasy_(genre)"),
        (4, "X"),                        # no prefix: genre NULL
        (5, R + "Category:s1"),
        (6, R + "Category:s2"),
        (7, "X"),                        # subject without prefix: skipped
        (8, R + "Category:s3"),
        (9, R + "size_3"),
    ]
    triples = [
        (10, 2, 2), (10, 1, 2),          # triple order a, b; entity order b, a
        (10, 3, 4),
        (10, 8, 7), (10, 5, 7), (10, 7, 7), (10, 6, 7),
        (11, 4, 4),
        (12, 9, 6),                      # only an ignored code
        (13, 99, 2),                     # unknown entity id
    ]
    f = _features(spark, triples, entities)
    assert f[10]["author"] == "b"
    assert f[10]["genre"] == "Fantasy"
    assert f[10]["subject"] == "s1,s2,s3,"
    assert f[11]["genre"] is None
    for item in (12, 13):
        assert all(f[item][c] is None for c in ("author", "genre", "series", "publisher", "subject"))
    assert set(f) == {10, 11, 12, 13}


def test_split_quota_half_even(spark):
    sizes = [1, 2, 3, 5, 7, 8, 12, 13]
    rows = [(u, i, 1) for u, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, schemas.INTERACTIONS)
    out = split.split_counts_by_user(split.assign_split(df, 0.2, 42))
    got = {r["user_id"]: r["n_dev"] for r in out.collect()}
    assert [got[u] for u in range(len(sizes))] == [0, 0, 1, 1, 1, 2, 2, 3]
    out = split.split_counts_by_user(split.assign_split(spark.createDataFrame(
        [(u, i, 1) for u, n in enumerate(range(1, 8)) for i in range(n)], schemas.INTERACTIONS), 0.5, 42))
    got = {r["user_id"]: r["n_dev"] for r in out.collect()}
    assert [got[u] for u in range(7)] == [0, 1, 2, 2, 2, 3, 4]


def test_split_duplicates_and_null_user(spark):
    rows = [(1, 5, 1)] * 6 + [(None, 5, 1)] * 5
    df = spark.createDataFrame(rows, schemas.INTERACTIONS)
    out = split.assign_split(df, 0.5, 42).collect()
    assert len(out) == 11
    assert sum(r["split"] == "dev" for r in out if r["user_id"] == 1) == 3
    assert all(r["split"] == "train" for r in out if r["user_id"] is None)


def test_profiles_sorted_distinct_and_cold_start(spark):
    rows = spark.createDataFrame(
        [(1, 10, 1), (1, 11, 1), (1, 12, 1), (2, 13, 1), (3, 10, 0), (4, 10, None)], schemas.INTERACTIONS
    )
    feats = spark.createDataFrame(
        [(10, None, "B", None, None, None), (11, None, "A", None, None, None),
         (12, None, "B", None, None, None), (13, None, "", None, None, None)],
        schemas.ITEM_FEATURES,
    )
    prof = {r["user_id"]: r["user_genres"] for r in profiles.user_profiles(rows, feats).collect()}
    assert prof == {1: "A, B", 2: ""}
    tagged = rows.withColumn("split", F.lit("train"))
    exs = {r["user_id"]: r for r in profiles.build_examples(tagged, profiles.user_profiles(rows, feats), feats).collect()}
    assert exs[3]["user_genres"] == "" and exs[3]["item_genre"] == "B"


def test_text_and_structured_filters(spark):
    exs = spark.createDataFrame(
        [(1, 10, 1, "g", "G"), (1, 11, 1, "g", "G"), (1, 12, 1, "g", "G")], schemas.EXAMPLES
    )
    texts = spark.createDataFrame([(10, "text"), (11, "")], schemas.TEXTS)
    assert [r["item_id"] for r in ex.text_examples(exs, texts).collect()] == [10]
    feats = spark.createDataFrame(
        [(10, "a", "G", "s", "p", "x,"), (11, "a", "G", None, "p", "x,")], schemas.ITEM_FEATURES
    )
    out = ex.structured_examples(exs, feats).collect()
    assert [r["item_id"] for r in out] == [10]
    assert out[0]["item_series"] == "s"


def test_null_label_passes_positives_not_profiles(spark):
    df = spark.createDataFrame([(1, 2, None), (1, 3, 0), (1, 4, 1)], schemas.INTERACTIONS)
    assert sorted(r["item_id"] for r in export.positives(df).collect()) == [2, 4]


def _render(spark, template, user_genres, item_text="t"):
    run = PromptRun("r", "text", template, "No", "Yes")
    row = spark.createDataFrame(
        [(1, 2, 1, user_genres, "", item_text)],
        "user_id long, item_id long, label int, user_genres string, item_genre string, item_text string",
    )
    return prompts.training_prompts(row, [run], "text").collect()[0]


def test_placeholder_inside_text_is_replaced(spark):
    r = _render(spark, "u*user_id* i*item_id* *item_text*", "A, B", item_text="has *user_genres*")
    assert r["prompt"] == "u1 i2 has A, B"
    assert r["label_word"] == "Yes"


def test_cold_start_phrase(spark):
    shipped = _render(spark, "User likes the book genres: *user_genres*, ok?", "")
    assert shipped["prompt"] == "User likes the book genres: *user_genres*, ok?"
    exact = _render(spark, "X. User likes the book genres *user_genres*.", "")
    assert exact["prompt"] == "X. We don't know which genres the user likes."


def test_ranking_ties_and_gapless(spark):
    scores = spark.createDataFrame(
        [("r", 1, 6, 0.3), ("r", 1, 5, 0.3), ("r", 1, 7, 0.9), ("r", 2, 1, 0.1)], schemas.SCORES
    )
    got = {(r["user_id"], r["item_id"]): r["rank"] for r in scoring.rank_scores(scores).collect()}
    assert got == {(1, 7): 1, (1, 5): 2, (1, 6): 3, (2, 1): 1}


def test_latest_score_wins(spark):
    scores = spark.createDataFrame(
        [("r", 1, 5, 0.1, 0), ("r", 1, 5, 0.7, 1)],
        "run_name string, user_id long, item_id long, score double, seq int",
    )
    assert scoring.latest_scores(scores, "seq").collect()[0]["score"] == 0.7


def test_last_score_under_any_partitioning(spark):
    seq = "struct<file:string,line:bigint>"
    rows = [("r", 1, 5, f"p{k}", "Yes", (f"part-{k // 40}", k % 40)) for k in range(100)] + [("r", 1, 6, "q", "Yes", ("part-0", 0))]
    df = spark.createDataFrame(rows, f"run_name string, user_id long, item_id long, prompt string, word_pos string, seq {seq}")

    def scorer(batch):
        return [float(p[1:] or 0) for p in batch["prompt"]]

    for parts in (1, 3, 16):
        scores = scoring.score_prompts(df.orderBy(F.rand(parts)).repartition(parts), scorer)
        got = {r["item_id"]: r["score"] for r in scoring.latest_scores(scores).collect()}
        assert got == {5: 99.0, 6: 0.0}
    # without an order the highest score is taken
    assert scoring.latest_scores(scores.drop("seq")).where("item_id = 5").first()["score"] == 99.0


def test_a_second_run_scores_only_what_is_new(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)
    ledger = str(tmp_path / "ledger")
    schema = "run_name string, user_id long, item_id long, prompt string, word_pos string"

    def scorer(batch):
        calls.add(len(batch))
        return batch["prompt"].str.len().astype("float64")

    def run(rows):
        before = calls.value
        got = sorted(tuple(r) for r in scoring.score_new_prompts(spark.createDataFrame(rows, schema), scorer, ledger).collect())
        return got, calls.value - before

    first = [("r", 1, 5, "abc", "Yes"), ("r", 1, 6, "abcd", "Yes"), ("r", 1, 6, "abcd", "Yes")]
    assert run(first) == ([("r", 1, 5, 3.0), ("r", 1, 6, 4.0)], 2)
    assert run(first) == ([("r", 1, 5, 3.0), ("r", 1, 6, 4.0)], 0)
    # a changed prompt is scored anew, the old score stays out of the result
    assert run([*first[:1], ("r", 1, 6, "changed", "Yes"), ("q", 1, 6, "abcd", "Yes")]) == (
        [("q", 1, 6, 4.0), ("r", 1, 5, 3.0), ("r", 1, 6, 7.0)], 2)
    assert run([]) == ([], 0)


def test_prediction_cleaning_and_accuracy(spark):
    df = spark.createDataFrame([("<pad> Yes</s>", "Yes"), ("Yes", "Yes")], "pred_raw string, label_word string")
    assert [r[0] for r in df.select(clean_prediction(F.col("pred_raw"))).collect()] == ["Yes", ""]
    assert metrics.answer_accuracy(df).collect()[0]["acc"] == 0.5


def test_semi_and_anti_join(spark):
    preds = spark.createDataFrame([(1, 5, 1), (1, 6, 2), (9, 5, 1)], schemas.RANKED_PREDICTIONS)
    truth = spark.createDataFrame([(1, 5, 1)], schemas.INTERACTIONS)
    assert sorted(r["item_id"] for r in export.evaluable_predictions(preds, truth).collect()) == [5, 6]
    assert [r["user_id"] for r in export.dropped_users(preds, truth).collect()] == [9]


def test_truncate_words_leading_blanks(spark):
    df = spark.createDataFrame([("  a b c",), ("\ta b",), ("x",), ("",)], "t string")
    out = [r[0] for r in df.select(truncate_words(F.col("t"), 2)).collect()]
    assert out == ["a b", "a b", "x", ""]
    blank = spark.createDataFrame([("\t\n",), ("a b\n",)], "t string")
    assert [r[0] for r in blank.select(truncate_words(F.col("t"), 5)).collect()] == ["", "a b"]


def test_truncate_words_has_no_limit(spark):
    df = spark.createDataFrame([(" ".join(f"w{i}" for i in range(20_000)),)], "t string")
    for n in (5_000, 19_999, 20_000, 30_000):
        assert df.select(F.size(F.split(truncate_words(F.col("t"), n), " "))).first()[0] == min(n, 20_000)


def test_candidates_for_user(spark):
    c = spark.createDataFrame([(1, 5), (2, 6)], "user_id long, item_id long")
    assert [r["item_id"] for r in ex.candidates_for_user(c, 2).collect()] == [6]


def test_unknown_task_raises():
    import pytest

    with pytest.raises(ValueError, match="Task not found"):
        metrics.get_task("nope")


def test_concat_rendering_equals_sequential_replacement(spark):
    from shelfwise.functions.prompt import render_pieces, render_text, text_pieces

    rows = spark.createDataFrame(
        [(1, 2, "A, B", "has *user_genres* and *item_id*"), (None, 3, "", "x"), (4, 5, "G", "")],
        "user_id long, item_id long, user_genres string, item_text string",
    )
    templates = [r.template for r in prompts.default_runs("text")] + [
        "User likes the book genres *user_genres* *item_text**user_id*",
        "*item_*user_id*id* odd",        # stray '*': falls back to nested replace
        "no placeholders",
    ]
    schema = "template string, pieces array<struct<text:string,place:int>>"
    data = spark.createDataFrame([(t, text_pieces(t)) for t in [*templates, ""]], schema)
    got = rows.join(data).select("template", render_pieces(F.col("pieces"), F.col("template")).alias("a"), render_text(F.col("template")).alias("b"))
    assert got.count() == 3 * (len(templates) + 1) and got.where("NOT a <=> b").isEmpty()
    assert text_pieces("*item_*user_id*id* odd") is None and text_pieces("x *user_id*") == [("x ", None), ("", 0)]


def test_many_runs(spark):
    rows = spark.createDataFrame([(1, 2, 1, "A", "text")], "user_id long, item_id long, label int, user_genres string, item_text string")
    runs = [prompts.PromptRun(f"r{i}", "text", f"{i}: *item_text* for *user_id*", "No", "Yes") for i in range(1500)]
    got = {r["run_name"]: (r["prompt"], r["label_word"]) for r in prompts.training_prompts(rows, runs, "text").collect()}
    assert got == {f"r{i}": (f"{i}: text for 1", "Yes") for i in range(1500)}
    plans = [prompts.training_prompts(rows, runs[:n], "text")._jdf.queryExecution().optimizedPlan().toString() for n in (1, 1500)]
    assert abs(len(plans[0]) - len(plans[1])) < 50


def test_cold_start_parameter(spark):
    rows = spark.createDataFrame([(1, 2, "", "t")], "user_id long, item_id long, user_genres string, item_text string")
    run = prompts.PromptRun("r", "text", "likes *user_genres*. *item_text*", "No", "Yes")
    got = prompts.ranking_prompts(rows, [run], "text", cold_start=("likes *user_genres*", "is new")).first()["prompt"]
    assert got == "is new. t"


def test_scorer_output_is_checked(spark):
    import pytest

    rows = spark.createDataFrame([("r", 1, 5, "p", "Yes"), ("r", 1, 6, "p", "Yes")], "run_name string, user_id long, item_id long, prompt string, word_pos string").coalesce(1)
    with pytest.raises(Exception, match="1 scores for 2 prompts"):
        scoring.score_prompts(rows, lambda b: [0.5]).collect()
    with pytest.raises(Exception, match="missing score"):
        scoring.score_prompts(rows, lambda b: [0.5, float("nan")]).collect()


def test_repeated_candidate_counts_once(spark):
    rows = spark.createDataFrame([("r", 1, 5, "p", "Yes"), ("r", 1, 5, "p", "Yes"), ("r", 1, 6, "q", "Yes")],
                                 "run_name string, user_id long, item_id long, prompt string, word_pos string")
    got = scoring.scored_ranking(rows, scoring.StubScorer()).collect()
    assert sorted((r["item_id"], r["rank"]) for r in got) == [(5, 2), (6, 1)]


def test_shared_folder_is_needed_off_local():
    import pytest

    from shelfwise import session

    class Context:
        master = "spark://host:7077"
        getConf = staticmethod(lambda: {})
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())
