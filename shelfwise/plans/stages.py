"""File-based stages on the original on-disk layout (TSV in, TSV out).

    raw/<ds>/mapping_entities.tsv, raw/<ds>/item-prop/train.tsv
        -> map_item_features -> interim/<ds>/item-prop/train.tsv
    raw/<ds>/train.tsv, raw/<ds>/test.tsv
        -> train_dev_split -> interim/<ds>/interactions/split={train,dev,test}
    interim -> build_user_profiles -> processed/<ds>/examples/split={train,dev,test}
    raw/<ds>/texts/<item>.text -> truncate_texts -> processed/<ds>/texts (parquet)
    processed + texts + runs -> rank_candidates -> results/run_name=<run>/
    raw test/train (+ texts or item features) -> export_ground_truth -> eval/<ds>[_structured]/
    results + ground truth -> filter_predictions -> results-evaluable/run_name=<run>/

Each "file" is a Spark output folder (part files), the scalable form of one
TSV. Every stage reads its inputs with explicit schemas and writes whole
outputs; nothing passes through the driver. Command line:
``python -m shelfwise.plans.stages {prepare,rank,export,filter} ...``.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.fixed_values import DEV_FRACTION, MAX_TEXT_TOKENS, SPLIT_SEED
from shelfwise.operators import examples as ex
from shelfwise.operators import export, features, profiles, prompts, scoring, split, truncate
from shelfwise.sources import text_files, tsv


def _p(*parts: str) -> str:
    return os.path.join(*parts)


def map_item_features(spark: SparkSession, data_dir: str, dataset: str = "dbbook") -> DataFrame:
    ents = tsv.read_entities(spark, _p(data_dir, "raw", dataset, "mapping_entities.tsv"))
    triples = tsv.read_item_prop(spark, _p(data_dir, "raw", dataset, "item-prop", "train.tsv"))
    out = features.item_features(triples, ents, entity_order="seq", triple_order="seq")
    tsv.write_tsv(out, _p(data_dir, "interim", dataset, "item-prop", "train.tsv"))
    return out


def train_dev_split(
    spark: SparkSession, data_dir: str, dataset: str = "dbbook", dev_size: float = DEV_FRACTION, seed: int = SPLIT_SEED
) -> None:
    raw_train = tsv.read_interactions(spark, _p(data_dir, "raw", dataset, "train.tsv"))
    test = tsv.read_interactions(spark, _p(data_dir, "raw", dataset, "test.tsv"))
    rows = profiles.tag_splits(split.assign_split(raw_train, dev_size, seed), test)
    tsv.write_splits(rows, _p(data_dir, "interim", dataset, "interactions"))


def _interim(spark: SparkSession, data_dir: str, dataset: str) -> DataFrame:
    """Every split's interactions, with ``split``, from one scan."""
    return tsv.read_splits(spark, _p(data_dir, "interim", dataset, "interactions"))


def build_user_profiles(spark: SparkSession, data_dir: str, dataset: str = "dbbook") -> None:
    feats = tsv.read_item_features(spark, _p(data_dir, "interim", dataset, "item-prop", "train.tsv"))
    rows = _interim(spark, data_dir, dataset)
    prof = profiles.user_profiles(rows.where(F.col("split") == "train"), feats)
    tsv.write_splits(profiles.build_examples(rows, prof, feats), _p(data_dir, "processed", dataset, "examples"))


def truncate_texts(
    spark: SparkSession, data_dir: str, dataset: str = "dbbook", max_tokens: int = MAX_TEXT_TOKENS,
    tokenizer_factory=None,
) -> None:
    raw = text_files.read_text_folder(spark, _p(data_dir, "raw", dataset, "texts"))
    if tokenizer_factory is None:
        out = truncate.truncate_texts(raw, max_tokens)
    else:
        out = truncate.truncate_texts_tokenizer(raw, tokenizer_factory, max_tokens)
    text_files.write_texts(out, _p(data_dir, "processed", dataset, "texts"))


def _processed(spark: SparkSession, data_dir: str, dataset: str, split_name: str) -> DataFrame:
    """One split's examples, in the order of its files (``seq``)."""
    path = _p(data_dir, "processed", dataset, "examples", f"split={split_name}")
    return tsv.read_examples(spark, path, with_seq=True).na.fill("")


def rank_candidates(
    spark: SparkSession,
    data_dir: str,
    runs: list[prompts.PromptRun],
    scorer: scoring.Scorer,
    results_dir: str,
    dataset: str = "dbbook",
) -> DataFrame:
    """C13 for every run and every test user at once; one folder per run."""
    test = _processed(spark, data_dir, dataset, "test")
    ranked = []
    if any(r.kind == "text" for r in runs):
        texts = text_files.read_texts(spark, _p(data_dir, "processed", dataset, "texts"))
        cands = ex.ranking_candidates_text(test, texts)
        ranked.append(scoring.scored_ranking(prompts.ranking_prompts(cands, runs, "text"), scorer))
    if any(r.kind == "structured" for r in runs):
        feats = tsv.read_item_features(spark, _p(data_dir, "interim", dataset, "item-prop", "train.tsv"))
        cands = ex.ranking_candidates_structured(test, feats)
        ranked.append(scoring.scored_ranking(prompts.ranking_prompts(cands, runs, "structured"), scorer))
    out = ranked[0]
    for r in ranked[1:]:
        out = out.unionByName(r)
    tsv.write_ranked_predictions(out, results_dir)
    return out


def export_ground_truth(
    spark: SparkSession, data_dir: str, dataset: str = "dbbook", out_folder: str = "eval"
) -> None:
    """Test positives with raw text / with complete features, train positives.

    Written to ``<data_dir>/<out_folder>/<dataset>[_structured]/`` for the
    ranking-evaluation tool; pass the folder name your tool expects.
    """
    raw_test = tsv.read_interactions(spark, _p(data_dir, "raw", dataset, "test.tsv"))
    raw_train = tsv.read_interactions(spark, _p(data_dir, "raw", dataset, "train.tsv"))
    texts = text_files.read_text_folder(spark, _p(data_dir, "raw", dataset, "texts"))
    feats = tsv.read_item_features(spark, _p(data_dir, "interim", dataset, "item-prop", "train.tsv"))
    train_pos = export.positives(raw_train)
    for suffix, truth in (("", export.ground_truth_text(raw_test, texts)),
                          ("_structured", export.ground_truth_structured(raw_test, feats))):
        tsv.write_tsv(truth, _p(data_dir, out_folder, f"{dataset}{suffix}", "test.tsv"))
        tsv.write_tsv(train_pos, _p(data_dir, out_folder, f"{dataset}{suffix}", "train.tsv"))


def filter_predictions(
    spark: SparkSession, results_dir: str, truth_paths: str | dict[str, str], out_dir: str,
    runs: list[prompts.PromptRun] | None = None,
) -> DataFrame:
    """Every run's predictions restricted to users with ground truth.

    ``truth_paths`` is one path for runs of one kind, or a path per kind
    (``{"text": ..., "structured": ...}``) together with the ``runs``, whose
    kinds say which truth a run is held against.

    Reads the per-run folders written by ``rank_candidates`` (rank = line
    order) and writes to a separate location (never into ``results_dir``).
    """
    preds = tsv.read_predictions(spark, _p(results_dir, "run_name=*"))
    if isinstance(truth_paths, str):
        kept = export.evaluable_predictions(preds, tsv.read_ground_truth(spark, truth_paths))
    else:
        if not runs:
            raise ValueError("a truth per kind needs the runs")
        kept = None
        for kind, path in truth_paths.items():
            own = preds.where(F.col("run_name").isin([r.run_name for r in runs if r.kind == kind]))
            part = export.evaluable_predictions(own, tsv.read_ground_truth(spark, path))
            kept = part if kept is None else kept.unionByName(part)
    tsv.write_ranked_predictions(kept, out_dir)
    return kept


def prepare(spark: SparkSession, data_dir: str, dataset: str = "dbbook") -> None:
    """The four preparation stages in order."""
    map_item_features(spark, data_dir, dataset)
    train_dev_split(spark, data_dir, dataset)
    build_user_profiles(spark, data_dir, dataset)
    truncate_texts(spark, data_dir, dataset)


def _load_scorer(spec: str | None) -> scoring.Scorer:
    """``module:callable`` returning a scorer (called once); default: stub."""
    if not spec:
        return scoring.StubScorer()
    import importlib

    module, _, attr = spec.partition(":")
    factory = getattr(importlib.import_module(module), attr)
    return factory()


def main(argv: list[str]) -> None:
    import argparse

    from shelfwise.session import build_session
    from shelfwise.sources.params import read_prompt_runs

    parser = argparse.ArgumentParser(prog="python -m shelfwise.plans.stages")
    sub = parser.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("prepare", help="item features, split, profiles/examples, truncated texts")
    p.add_argument("data_dir")
    p.add_argument("--dataset", default="dbbook")
    p = sub.add_parser("rank", help="score and rank the test candidates for every run")
    p.add_argument("data_dir")
    p.add_argument("params_dir", help="folder of run parameter JSON files")
    p.add_argument("results_dir")
    p.add_argument("--scorer", help="module:callable returning the scorer (default: deterministic stub)")
    p.add_argument("--dataset", default="dbbook")
    p = sub.add_parser("export", help="ground truth for text and structured runs")
    p.add_argument("data_dir")
    p.add_argument("--dataset", default="dbbook")
    p.add_argument("--out-folder", default="eval")
    p = sub.add_parser("filter", help="keep predictions of users with ground truth")
    p.add_argument("results_dir")
    p.add_argument("truth_path", help="ground truth of text runs (of all runs without --params)")
    p.add_argument("out_dir")
    p.add_argument("--structured", help="ground truth of structured runs")
    p.add_argument("--params", help="folder of run parameter JSON files, with --structured")
    args = parser.parse_args(argv)

    spark = build_session()
    if args.cmd == "prepare":
        prepare(spark, args.data_dir, args.dataset)
    elif args.cmd == "rank":
        runs = read_prompt_runs(spark, args.params_dir)
        rank_candidates(spark, args.data_dir, runs, _load_scorer(args.scorer), args.results_dir, args.dataset)
    elif args.cmd == "export":
        export_ground_truth(spark, args.data_dir, args.dataset, args.out_folder)
    else:
        truth = {"text": args.truth_path, "structured": args.structured} if args.structured else args.truth_path
        filter_predictions(spark, args.results_dir, truth, args.out_dir, read_prompt_runs(spark, args.params) if args.params else None)


if __name__ == "__main__":
    main(sys.argv[1:])
