"""File-based stages on the original layout agree with the in-memory plan."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from shelfwise.fixed_values import PROMPT_RUNS
from shelfwise.plans import stages
from shelfwise.plans.recplan import RecPlan
from shelfwise.sources import text_files, tsv
from shelfwise.sources.params import read_prompt_runs

SF = "/root/testdata/sf0.001"


def _write_raw(spark, plan, root):
    raw = os.path.join(root, "raw", "dbbook")
    os.makedirs(os.path.join(raw, "item-prop"))
    os.makedirs(os.path.join(raw, "texts"))
    ents = plan.views.mapping_entities.orderBy("id").collect()  # tiny fixture, test only
    with open(os.path.join(raw, "mapping_entities.tsv"), "w") as f:
        f.write("header line one\nheader line two\n")
        f.writelines(f"{r['id']}\t{r['prop']}\n" for r in ents)
    tsv.write_tsv(plan.views.item_prop.coalesce(1), os.path.join(raw, "item-prop", "train.tsv"))
    tsv.write_tsv(plan.views.raw_train, os.path.join(raw, "train.tsv"))
    tsv.write_tsv(plan.views.raw_test, os.path.join(raw, "test.tsv"))
    for r in plan.views.texts.collect():
        with open(os.path.join(raw, "texts", f"{r['item_id']}.text"), "w", encoding="utf-8") as f:
            f.write(r["item_text"])


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stages_match_plan(spark):
    plan = RecPlan(spark, SF)
    root = tempfile.mkdtemp(prefix="shelfwise-stages-")
    _write_raw(spark, plan, root)
    stages.prepare(spark, root)

    feats = tsv.read_item_features(spark, os.path.join(root, "interim", "dbbook", "item-prop", "train.tsv"))
    assert _same(feats, plan.item_features)

    dev = tsv.read_interactions(spark, os.path.join(root, "interim", "dbbook", "interactions", "split=dev"))
    assert _same(dev, plan.split_assignment.where("split = 'dev'").drop("split"))

    train = tsv.read_examples(spark, os.path.join(root, "processed", "dbbook", "examples", "split=train")).na.fill("")
    assert _same(train, plan.examples_split("train"))

    texts = text_files.read_texts(spark, os.path.join(root, "processed", "dbbook", "texts"))
    assert _same(texts.where("item_text != ''"), plan.truncated_texts.where("item_text != ''"))

    params_dir = os.path.join(root, "params")
    os.makedirs(params_dir)
    for run_name, _kind, template, mapping in PROMPT_RUNS:
        with open(os.path.join(params_dir, f"{run_name}.json"), "w") as f:
            json.dump({"run_name": run_name, "template": template, "mapping": mapping, "seed": 42}, f)
    results = os.path.join(root, "results")
    stages.main(["rank", root, params_dir, results, "--scorer", "shelfwise.operators.scoring:StubScorer"])
    back = tsv.read_predictions(spark, os.path.join(results, "run_name=*"))
    expected = plan.scored_ranking.unionByName(plan.scored_ranking_structured).drop("score")
    assert _same(back, expected)

    stages.export_ground_truth(spark, root)
    truth_path = os.path.join(root, "eval", "dbbook", "test.tsv")
    truth = tsv.read_ground_truth(spark, truth_path)
    assert _same(truth, plan.ground_truth_text)

    runs = read_prompt_runs(spark, params_dir)
    paths = {"text": truth_path, "structured": os.path.join(root, "eval", "dbbook_structured", "test.tsv")}
    kept = stages.filter_predictions(spark, results, paths, os.path.join(root, "results-evaluable"), runs)
    structured = [r.run_name for r in runs if r.kind == "structured"]
    for kind, path in paths.items():  # each run against the truth of its kind
        users = tsv.read_ground_truth(spark, path).select("user_id").distinct()
        of_kind = F.col("run_name").isin(structured) if kind == "structured" else ~F.col("run_name").isin(structured)
        assert _same(kept.where(of_kind), expected.where(of_kind).join(users, "user_id", "left_semi").select(*kept.columns))
