"""What a stored step leaves on the disk, and what is shuffled."""

import os
import tempfile
import threading
import time

from pyspark import InheritableThread
from pyspark.sql import functions as F

from shelfwise import session
from shelfwise.operators import examples, profiles, prompts, split
from shelfwise.plans.recplan import RecPlan
from shelfwise.sources.tables import DRIVER_SCHEMAS


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def _left(spark, before, seconds=10):
    """Shuffle files made since; they go a moment after a query's end."""
    until = time.time() + seconds
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


def _tables(spark):
    """Small tables with missing and repeated keys, texts for some items."""
    folder = tempfile.mkdtemp(prefix="shelfwise-disk-")
    rows = {
        "orders": [(o if o != 7 else None, o % 23 if o % 29 else None, "O", 1.0, "1") for o in range(120)] + [(3, 4, "O", 1.0, "1")],
        "lineitem": [(n % 120, (n * 7) % 60 if n % 31 else None, n % 5, 1, 1.0, 1.0, 0.0, 0.0, "R" if n % 4 == 0 else "N", "F") for n in range(900)],
        "part": [(p, f"w{p % 5} v{p % 3}", f"B{p % 4}", f"T{p % 6}", p % 9, 1.0) for p in range(60)] + [(5, "w0 v2", "B1", "T9", 5, 1.0)],
        "supplier": [(s, f"S{s}", 0, 0.0) for s in range(5)],
        "documents": [(d, ["", None, "two  words", "a *user_genres* text"][d % 4], "en", "s", 1) for d in range(45)] + [(2, "again", "en", "s", 1)],
    }
    for name, made in rows.items():
        spark.createDataFrame(made, DRIVER_SCHEMAS[name]).write.parquet(os.path.join(folder, f"{name}.parquet"))
    return folder


def test_a_stored_step_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    made = spark.range(2000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
    stored = session.materialize(made)
    assert not _left(spark, before)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, made.collect()))


def test_the_setting_is_as_before_whoever_ends_last(spark):
    inside, go = threading.Barrier(3), [threading.Event(), threading.Event()]

    def hold(k):
        with session._shuffles_freed(spark):
            inside.wait(10)
            go[k].wait(10)

    for given in (None, "false", "true"):
        if given is not None:
            spark.conf.set(session._FREE, given)
        inside.reset()
        threads = [InheritableThread(target=hold, args=(k,), session=spark) for k in (0, 1)]
        for e in go:
            e.clear()
        for t in threads:
            t.start()
        inside.wait(10)
        go[0].set()
        threads[0].join()
        assert spark.conf.get(session._FREE) == "true"
        go[1].set()
        threads[1].join()
        assert spark.conf.get(session._FREE, None) == given
        spark.conf.unset(session._FREE)


def test_the_order_key_of_the_split_is_not_shuffled(spark, monkeypatch):
    rows = spark.createDataFrame([(u if u else None, i, i % 2) for u in range(6) for i in range(40)] + [(1, None, 1), (1, 3, 1), (1, 3, 1)],
                                 "user_id long, item_id long, label int")
    whole = split.assign_split(rows, 0.2, 42, skew_safe=False)
    for limit in (10_000, 5):
        monkeypatch.setattr(split, "HOT_ROWS", limit)
        made = split.assign_split(rows, 0.2, 42)
        assert made.exceptAll(whole).isEmpty() and whole.exceptAll(made).isEmpty(), limit
        lines = _plan(split._ranked_by_bucket(rows.where("user_id IS NOT NULL"), 42)).splitlines()
        dealt = next(i for i, line in enumerate(lines) if "RepartitionByExpression" in line)
        assert "_key#" in "".join(lines[:dealt]) and "_key#" not in "".join(lines[dealt:])


def test_prompts_read_stored_profiles_and_unstored_triples(spark):
    folder, before = _tables(spark), _shuffle_files(spark)
    plan = RecPlan(spark, folder)
    made = plan.prompts_text_multi
    assert not _left(spark, before)
    assert "item_prop" not in vars(plan.views) and "collect_set" not in _plan(made)
    for name in ("structured_examples", "ranking_candidates_structured"):  # the features read the triples too: they are stored
        both = RecPlan(spark, folder)
        getattr(both, name)
        assert "item_prop" in vars(both.views)
    # the same from profiles and triples made the other way
    other = RecPlan(spark, folder)
    assert other.views.item_prop.exceptAll(other.views.numbered_triples()).isEmpty()
    rows = profiles.tag_splits(other.split_rows, other.views.raw_test)
    built = profiles.build_examples(rows, other.user_profiles, other.item_features, other.join)
    want = prompts.training_prompts(examples.text_examples(built, other.truncated_texts), other.runs, "text")
    assert want.count() > 100 and made.exceptAll(want).isEmpty() and want.exceptAll(made).isEmpty()
