"""Filtering stages: each operator's decision put into effect on a documents table.

In every stage the columns of ``docs`` stay as they are, whatever others it has; a NULL
text counts as empty, a row is named by its id (a NULL id sorts last) and the whole hash
of its text, rows that repeat both get one decision, an empty table gives an
empty one, and a text of any length is read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm import decontaminate, exact_dedup, packing, simhash, toxicity
from shelfwise.llm.common import apply_decisions, stored
from shelfwise.llm.labelled import sample


def drop_toxic(docs: DataFrame, labelled_docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Documents that score under ``threshold``; the field is fitted on ``labelled_docs``.

    Empty and NULL texts get the score of any text without a toxic token, which follows from the labels' odds.
    All rows of a repeated document stay or go together. Without labelled documents of either label nothing is toxic.
    """
    model = toxicity.fit(*sample(labelled_docs, labels, "toxic", 4, 2))
    scored = toxicity.tag(docs, model)
    return apply_decisions(docs, scored.select("ord", "h", (F.col("score") < threshold).alias("keep")))


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each group of equal texts: the longest before white space is deleted, of these the smallest id.

    Empty, NULL and blank texts are one group. Of rows that repeat the one that stays, one stays.
    """
    found = exact_dedup.deduplicate(docs)
    return apply_decisions(docs, found.select("ord", "h", (F.col("row") == F.col("keep_row")).alias("keep")))


def drop_near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """The document of the smallest id of each component; ids are tied by the text's hash, repeated rows leave one.

    Texts without a word share the fingerprint zero and are one component. Documents without id in different
    components stay apart.
    """
    found = stored(simhash.near_duplicates(docs, words, max_bits).select("ord", "h", "root"), "components")
    # Components may share their smallest id (a NULL id, or an id of several texts), so the root names them. Several
    # rows of one may have its smallest id: the smallest text hash, and one row of it.
    best = found.groupBy("root").agg(F.min(F.struct("ord", "h")).alias("best")).select("root", "best.*")
    repeats = (found.join(best, ["root", "ord", "h"], "left_semi")
               .withColumn("nth", F.row_number().over(Window.partitionBy("ord", "h").orderBy("root"))))
    dropped = found.join(best, ["root", "ord", "h"], "left_anti").select("ord", "h", F.lit(False).alias("keep"))
    return apply_decisions(docs, dropped.unionByName(repeats.select("ord", "h", (F.col("nth") == 1).alias("keep"))))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without a benchmark window.

    Documents without a word stay; benchmark items without a word, or an empty benchmark, hit nothing. All rows of
    a repeated document stay or go together.
    """
    found = decontaminate.find_contamination(docs, benchmark)
    return apply_decisions(docs, found.select("ord", "h", (F.col("n_hit") == 0).alias("keep")))


def pack(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """The documents' tokens in sequences, a row per piece; an empty or NULL text is its end token alone.

    Each row is a document of its own, also where rows repeat or have no id. ``tokenizer_path`` names a tokenizer
    that lower-cases and splits at white space, as the cache of words in ``packing`` takes for granted.
    """
    return packing.as_contract(packing.pack(docs, tokenizer_path))
