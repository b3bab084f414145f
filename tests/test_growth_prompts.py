"""Work per prompt, text and join that must not follow the length of what it passes on."""

import re

import pandas as pd
from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.fixed_values import RESOURCE_PREFIX as R
from shelfwise.fixed_values import STRUCTURED_PLACEHOLDERS, TEXT_PLACEHOLDERS
from shelfwise.functions.prompt import render, value_pieces
from shelfwise.operators import examples, features, profiles, prompts, scoring, skew, split, truncate


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_text_is_cut_once_at_its_head(spark):
    rows = [(1, " \ta b\u0085 c \u0085"), (2, "\n "), (3, None), (4, ""), (5, "a  b \u0085"), (6, "w " * 5000), (7, "a b c d e \u0085")]
    texts = spark.createDataFrame(rows, "item_id long, item_text string")
    for n in (1, 2, 3, 4, 6):
        bare = F.regexp_replace("item_text", "^[\t\n\f\r ]+|[\t\n\f\r ]+$", "")
        whole = texts.select("item_id", F.array_join(F.slice(F.split(bare, "[\t\n\f\r ]+", n + 1), 1, n), " ").alias("item_text"))
        assert sorted(map(tuple, truncate.truncate_texts(texts, n).collect())) == sorted(map(tuple, whole.collect()))
    cut = examples.non_empty_texts(truncate.truncate_texts(texts, 3))
    assert sorted(r[0] for r in cut.collect()) == [1, 5, 6, 7]
    assert len(re.findall(r"\bsplit\(", _plan(cut))) == 1 and "regexp_extract" in _plan(cut)


def test_values_at_their_places_equal_sequential_replacement(spark):
    odd = ["", "G", None, "*user_genres*", "x *user_", "genres* y", "*item_subject*", "item_subject", "a * b", "User likes the book genres "]
    rows = [(i, i % 3 or None, odd[i % 10], *(odd[(i * k) % 10] for k in (3, 7, 9, 1, 5)), odd[(i // 10) % 10]) for i in range(300)]
    names = ["user_genres", "item_genre", "item_author", "item_series", "item_publisher", "item_subject", "item_text"]
    data = spark.createDataFrame(rows, "user_id long, item_id long, " + ", ".join(f"{c} string" for c in names)).withColumn("n", F.monotonically_increasing_id())
    more = ["*item_genre*user_id*item_id*", "*item_text**item_text* *user_genres*", "a * *item_id*", "", "*item_author**item_subject*. User likes the book genres *user_genres*"]
    for kind, places in (("text", TEXT_PLACEHOLDERS), ("structured", STRUCTURED_PLACEHOLDERS)):
        runs = [*prompts.default_runs(kind), *[prompts.PromptRun(f"r{i}", kind, t, "No", "Yes") for i, t in enumerate(more)]]
        assert all(value_pieces(r.template, places) for r in prompts.default_runs(kind))
        got = prompts._with_prompts(data, runs, prompts.COLD_START).select("run_name", "n", F.col("prompt").alias("a"))
        want = prompts.with_runs(data, runs).select("run_name", "n", render(F.col("template"), places).alias("b"))
        both = got.join(want, ["run_name", "n"])
        assert both.count() == len(rows) * len(runs) and both.where("NOT a <=> b").isEmpty(), kind
    assert value_pieces("*item_genre*user_id*item_id*", STRUCTURED_PLACEHOLDERS) is None


def test_only_hot_users_have_buckets(spark, monkeypatch):
    rows = spark.range(0, 4000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 300 + 100).cast("long").alias("user_id"),
                                       (F.col("id") % 1500).alias("item_id"), (F.col("id") % 3 != 0).cast("int").alias("label"))
    whole = split.assign_split(rows, 0.2, 42, skew_safe=False)
    for limit in (10_000, 100, 1):
        monkeypatch.setattr(split, "HOT_ROWS", limit)
        made = split.assign_split(rows, 0.2, 42)
        assert made.exceptAll(whole).isEmpty() and whole.exceptAll(made).isEmpty(), limit
    monkeypatch.setattr(split, "HOT_ROWS", 100)
    ranked = split._ranked_by_bucket(rows, 42)
    assert {r["user_id"] for r in ranked.where("_bucket != ''").collect()} == {7}


def test_hot_keys_are_read_from_the_stored_rows(spark, monkeypatch):
    read, hot_keys = [], skew.hot_keys
    monkeypatch.setattr(skew, "hot_keys", lambda probe, key, *a: read.append((key, _plan(probe))) or hot_keys(probe, key, *a))
    rows = spark.createDataFrame([(1, i % 5, 1, "train") for i in range(50)] + [(None, 3, 1, "train"), (2, None, 0, "dev")],
                                 "user_id long, item_id long, label int, split string")
    known = spark.createDataFrame([(1, "A")], "user_id long, user_genres string")
    items = spark.createDataFrame([(3, "g"), (4, None)], "item_id long, genre string")
    made = profiles.build_examples(rows, known, items, skew.skew_join)
    plain = profiles.build_examples(rows, known, items)
    assert made.exceptAll(plain).isEmpty() and plain.exceptAll(made).isEmpty()
    assert [k for k, _ in read] == ["user_id", "item_id"] and not any("Join" in p for _, p in read)


def test_genres_alone_equal_those_of_all_features(spark):
    triples = spark.createDataFrame([(1, 1, 4), (1, 2, 4), (2, 3, 5), (3, 9, 4), (None, 2, 4), (4, 1, 2)], schemas.ITEM_PROP)
    entities = spark.createDataFrame([(1, None), (2, R + "g_(genre)"), (3, R + "p"), (9, "no prefix")], schemas.ENTITIES)
    full = features.item_features(triples, entities).select("item_id", "genre")
    alone = features.item_features(triples, entities, codes=(features.PROP_GENRE,)).select("item_id", "genre")
    assert sorted(map(str, full.collect())) == sorted(map(str, alone.collect()))


def test_first_publisher_is_found_by_numbers(spark):
    triples = spark.createDataFrame([(1, i, 5) for i in range(10, 60)] + [(1, 5, 5), (2, 1, 5), (2, 10, 5), (3, 77, 5), (None, 11, 5), (4, 10, 2)], schemas.ITEM_PROP)
    entities = spark.createDataFrame([(1, None), *[(i, f"{R}p{i}") for i in range(10, 60)]], schemas.ENTITIES)
    made = features.first_publisher(triples, entities)
    assert {r["item_id"]: r["publisher"] for r in made.collect()} == {1: "p10", 2: None, None: "p11"}
    assert "min(id" in _plan(made)


def test_a_scorer_gets_prompts_by_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(scoring, "BATCH_BYTES", 1000)
    limit = scoring.BATCH_BYTES
    rows = spark.range(0, 400, 1, 2).select(F.lit("r").alias("run_name"), F.col("id").alias("user_id"), F.col("id").alias("item_id"),
                                            F.repeat(F.lit("é"), F.when(F.col("id") == 9, 3000).otherwise(50).cast("int")).alias("prompt"), F.lit("Yes").alias("word_pos"))

    def scorer(batch):
        assert list(batch.columns) == ["run_name", "user_id", "item_id", "prompt", "word_pos"]
        return pd.Series([float(batch["prompt"].str.len().sum())] * len(batch))

    src = scoring.pa.RecordBatch.from_pylist([{"prompt": "x" * n} for n in (600, 600, 10, 0, 5000, 1, 1)] + [{"prompt": None}])
    pieces = list(scoring._in_bytes(src))
    assert scoring.pa.Table.from_batches(pieces).to_pylist() == src.to_pylist() and len(pieces) > 2 and limit == 1000
    assert not list(scoring._in_bytes(src.slice(0, 0)))
    got = scoring.score_prompts(rows, scorer).collect()
    assert len(got) == 400 and got[0].asDict().keys() == {"run_name", "user_id", "item_id", "score"}
