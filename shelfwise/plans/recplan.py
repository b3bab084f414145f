"""The whole recommendation data flow as one DataFrame graph over the raw tables.

    item_prop + entities ─ item_features ─┬──────────────────────────────┐
    raw_train ─ assign_split ─ train/dev ─┤                              │
    raw_test ─────────────────────────────┴─ profiles ─ examples(split) ─┤
    texts ─ truncate ─ text examples / ranking candidates ─ prompts ─ score ─ rank
    raw_test + texts / item_features ─ ground truth ─ evaluable predictions

With ``materialize=True`` the stage outputs that several later stages read
(interactions, item features, split, examples) are written once as parquet in
the shared ``spark.checkpoint.dir`` (as the original pipeline writes interim
and processed files): lineage is cut, a lost executor never recomputes the
whole upstream and every later query reads the stored rows. That is the mode
for a production run at scale. The default keeps one lazy plan per query,
which is faster for a single query on small inputs. The raw views
(interactions, triples, entities), the split, the genres and the profiles under the examples are
stored in either mode, as the files they stand for. Model scores are always materialised (the model must
run once per prompt).
"""

from __future__ import annotations

from functools import cached_property

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.fixed_values import DEV_FRACTION, MAX_TEXT_TOKENS, PROP_GENRE, SPLIT_SEED
from shelfwise.operators import examples as ex
from shelfwise.operators import export, features, metrics, profiles, prompts, scoring, skew, split, subword, truncate
from shelfwise.session import materialize
from shelfwise.sources.fixtures import FixtureViews, build_run_answers


def _public_subwords() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


class RecPlan:
    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        scorer: scoring.Scorer | None = None,
        runs: list[prompts.PromptRun] | None = None,
        dev_fraction: float = DEV_FRACTION,
        seed: int = SPLIT_SEED,
        max_tokens: int = MAX_TEXT_TOKENS,
        materialize: bool = False,
        skew_safe: bool = False,
        subwords: tuple[str, str] | None = None,
    ):
        self.spark = spark
        self.materialize = materialize
        self.views = FixtureViews(spark, sf_dir)
        self.scorer = scorer or scoring.StubScorer()
        self.runs = runs or prompts.default_runs()
        self.dev_fraction = dev_fraction
        self.seed = seed
        self.max_tokens = max_tokens
        self.subwords = subwords  # vocabulary file and pattern
        self.join = skew.skew_join if skew_safe else skew.plain_join

    def _stage(self, df: DataFrame) -> DataFrame:
        return materialize(df) if self.materialize else df

    def _prepare(self, *names: str) -> None:
        """Build independent stages concurrently.

        The raw views under them are stored when first used. They are built from
        separate driver threads, which keep the caller's job group, so that
        their jobs run at the same time on the cluster.
        """
        pending = [n for n in names if n not in self.__dict__]
        if len(pending) > 1:
            threads = [InheritableThread(target=getattr, args=(self, n), session=self.spark) for n in pending]
            for t in threads:
                t.start()
            for t in threads:
                t.join()
            for n in pending:  # a failure in a thread comes up here
                getattr(self, n)

    # -- C1 -----------------------------------------------------------------
    @cached_property
    def item_features(self) -> DataFrame:
        return self._stage(features.item_features(self.views.item_prop, self.views.mapping_entities, join=self.join))

    @cached_property
    def item_first_publisher(self) -> DataFrame:
        return features.first_publisher(self.views.item_prop, self.views.mapping_entities)

    @cached_property
    def item_subjects(self) -> DataFrame:
        return features.item_subjects(self.views.item_prop, self.views.mapping_entities)

    @cached_property
    def item_genres(self) -> DataFrame:
        """``item_id, genre`` of the features, from triples of that code alone; stored, profiles and examples read it."""
        stored = self.materialize or "item_prop" in vars(self.views)
        triples = self.views.item_prop if stored else self.views.numbered_triples()
        made = features.item_features(triples, self.views.mapping_entities, join=self.join, codes=(PROP_GENRE,))
        return materialize(made.select("item_id", "genre"), "genres")

    @cached_property
    def features_and_genres(self) -> tuple[DataFrame, DataFrame]:
        """Both, for steps that read both: the features come first, so that the genres read their stored triples."""
        return self.item_features, self.item_genres

    # -- C2 -----------------------------------------------------------------
    @cached_property
    def split_assignment(self) -> DataFrame:
        return self._stage(split.assign_split(self.views.raw_train, self.dev_fraction, self.seed))

    @cached_property
    def split_rows(self) -> DataFrame:
        """The split as a stored table, which profiles and examples read."""
        return self.split_assignment if self.materialize else materialize(self.split_assignment, "split")

    @cached_property
    def split_counts_by_user(self) -> DataFrame:
        return split.split_counts_by_user(self.split_assignment)

    # -- C3 -----------------------------------------------------------------
    @cached_property
    def user_profiles(self) -> DataFrame:
        self._prepare("split_rows", "item_genres")
        train_rows = self.split_rows.where(F.col("split") == "train")
        return profiles.user_profiles(train_rows, self.item_genres, self.join)

    @cached_property
    def profile_rows(self) -> DataFrame:
        """The profiles as a stored table, which the examples read: the shuffles that make them go before the examples'.

        They are merged, not broadcast: many users share a profile, so the files say little of the rows' size.
        """
        return materialize(self.user_profiles, "profiles").hint("merge")

    @cached_property
    def examples(self) -> DataFrame:
        self._prepare("split_rows", "item_genres")
        rows = profiles.tag_splits(self.split_rows, self.views.raw_test)
        return self._stage(profiles.build_examples(rows, self.profile_rows, self.item_genres, self.join))

    @cached_property
    def test_examples(self) -> DataFrame:
        return self.examples_split("test")

    def examples_split(self, name: str) -> DataFrame:
        return profiles.examples_of(self.examples, name)

    # -- C4 -----------------------------------------------------------------
    @cached_property
    def truncated_texts(self) -> DataFrame:
        return truncate.truncate_texts(self.views.texts, self.max_tokens)

    @cached_property
    def truncated_texts_subword(self) -> DataFrame:
        vocabulary, pattern = self.subwords or _public_subwords()
        return subword.truncate_texts_subword(self.views.texts, vocabulary, pattern, self.max_tokens).select("item_id", "item_text")

    # -- C5-C8 --------------------------------------------------------------
    @cached_property
    def text_examples(self) -> DataFrame:
        return ex.text_examples(self.examples, self.truncated_texts, self.join)

    @cached_property
    def structured_examples(self) -> DataFrame:
        self._prepare("split_rows", "features_and_genres")
        return ex.structured_examples(self.examples, self.item_features, self.join)

    @cached_property
    def ranking_candidates_text(self) -> DataFrame:
        return ex.ranking_candidates_text(self.test_examples, self.truncated_texts)

    @cached_property
    def ranking_candidates_structured(self) -> DataFrame:
        self._prepare("split_rows", "features_and_genres")
        return ex.ranking_candidates_structured(self.test_examples, self.item_features)

    @cached_property
    def user_candidates(self) -> DataFrame:
        """The candidates of the user who has most."""
        candidates = self.ranking_candidates_text
        return ex.candidates_for_user(candidates, ex.busiest_user(candidates))

    # -- C9-C12 -------------------------------------------------------------
    @cached_property
    def prompts_text_multi(self) -> DataFrame:
        return prompts.training_prompts(self.text_examples, self.runs, "text")

    @cached_property
    def prompts_structured(self) -> DataFrame:
        return prompts.training_prompts(self.structured_examples, self.runs, "structured")

    @cached_property
    def ranking_prompts_text(self) -> DataFrame:
        return prompts.ranking_prompts(self.ranking_candidates_text, self.runs, "text")

    @cached_property
    def ranking_prompts_structured(self) -> DataFrame:
        return prompts.ranking_prompts(self.ranking_candidates_structured, self.runs, "structured")

    # -- C13 ----------------------------------------------------------------
    @cached_property
    def ranked_predictions(self) -> DataFrame:
        scores = materialize(self.views.scores.withColumn("run_name", F.lit("scores")), "scores")
        return scoring.rank_scores(scores).select("user_id", "item_id", "score", "rank")

    @cached_property
    def scored_ranking(self) -> DataFrame:
        return scoring.scored_ranking(self.ranking_prompts_text, self.scorer)

    @cached_property
    def scored_ranking_structured(self) -> DataFrame:
        return scoring.scored_ranking(self.ranking_prompts_structured, self.scorer)

    # -- C14, X4 ------------------------------------------------------------
    @cached_property
    def answer_accuracy(self) -> DataFrame:
        return metrics.answer_accuracy(self.views.answers)

    @cached_property
    def task_registry_accuracy(self) -> DataFrame:
        answers = build_run_answers(self.views.raw_test, self.runs)
        return metrics.task_accuracy(answers, "dbbook", ["run_name"])

    # -- C15-C18 ------------------------------------------------------------
    @cached_property
    def ground_truth_text(self) -> DataFrame:
        return export.ground_truth_text(self.views.raw_test, self.views.texts)

    @cached_property
    def ground_truth_structured(self) -> DataFrame:
        return export.ground_truth_structured(self.views.raw_test, self.item_features)

    @cached_property
    def train_positives(self) -> DataFrame:
        return export.positives(self.views.raw_train)

    @cached_property
    def evaluable_predictions(self) -> DataFrame:
        preds = self.views.predictions.select("user_id", "item_id", "rank")
        return export.evaluable_predictions(preds, self.ground_truth_text)

    @cached_property
    def dropped_users(self) -> DataFrame:
        return export.dropped_users(self.views.predictions, self.ground_truth_text)

    @cached_property
    def evaluable_predictions_all_runs(self) -> DataFrame:
        self._prepare("split_rows", "features_and_genres")
        # both kinds read the test examples, ranking and truth the features
        self.test_examples = materialize(self.test_examples, "test-examples")
        self.item_features = self.item_features if self.materialize else materialize(self.item_features, "features")
        ranked = self.scored_ranking.withColumn("kind", F.lit("text")).unionByName(
            self.scored_ranking_structured.withColumn("kind", F.lit("structured"))
        )
        out = export.evaluable_predictions_by_kind(
            ranked, {"text": self.ground_truth_text, "structured": self.ground_truth_structured}
        )
        return out.select("run_name", "user_id", "item_id", "rank")
