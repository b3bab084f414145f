"""Quality rules: measures of each text, and lines that too many documents of a host share.

Cross-document line frequency. Lines are normalised (A-Z lower-cased, white space
runs made one space, trimmed), hashed to 128 bits together with their host, and
the distinct documents of a host that hold a line are counted (documents with
equal texts are one document, so copies of a text don't make its lines frequent).
A line above both limits, ``max_docs`` documents and ``max_share`` of the host's
documents, is removed; a document that keeps less than ``min_left`` of its words
is rejected as depleted.

Only DataFrame functions are used. Measures are made in the scan stage. Hashes
are counted with partial aggregation by (line, document), so a line that stands
in a third of all documents is counted in many tasks. Documents meet the
frequent lines by hash: lines that hold more than a ten-thousandth of all
frequent places are at most ten thousand and are broadcast, the others go through
a shuffle join, where no line has more than that share. A text is handled as arrays
of its words inside one row (some 300 bytes a word while it is measured).

Nulls and edge cases. A NULL text counts as empty: no words, ``base_failed``. A
NULL host is a host of its own; without ``host_col`` the table is one host. Rows
with a NULL id, and rows that repeat id and text, get one answer each. Lines
without a word are never counted, equal or removed. An empty table gives no
rows. Other columns, whatever their names, are ignored by ``measure`` and
``judge`` and kept by ``cleaned``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import clean_text, free_name, ordinal, original_id, stored, text_hash

BLANK = r"[\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_DOCS = 10
MAX_SHARE = 0.05
MIN_LEFT = 0.5
#: Lines with more than one in so many of all frequent places are broadcast: at most so many lines.
HEAVY = 10_000
_HOST_SALTS = 32


def _words(text: Column) -> Column:
    return F.filter(F.split(text, BLANK + "+"), lambda w: w != "")


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def _normal(line: Column) -> Column:
    """ASCII letters lower-cased, white space runs as one space, none at the ends."""
    low = F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(low, BLANK + "+", " "))


def _hashed(hashes: Column) -> Column:
    """The three-word windows, each as 32 bits of its hash and 32 bits of its place, sorted."""
    some = F.greatest(F.size(hashes) - 2, F.lit(0))
    three = F.zip_with(F.zip_with(F.slice(hashes, 1, some), F.slice(hashes, 2, some), lambda a, b: F.xxhash64(a, b)),
                       F.slice(hashes, 3, some), lambda a, b: F.xxhash64(a, b))
    high = F.lit(-1 << 32)
    return F.sort_array(F.transform(three, lambda g, i: g.bitwiseAND(high).bitwiseOR(i.cast("long"))))


def _pairs(hashed: Column) -> Column:
    """Places of windows that share their 32 hash bits with another one: all repeated windows and a few more."""
    less = F.greatest(F.size(hashed) - 1, F.lit(0))
    place = F.lit((1 << 31) - 1).cast("long")
    both = F.zip_with(F.slice(hashed, 1, less), F.slice(hashed, 2, less), lambda a, b: F.when(
        F.shiftright(a, 32) == F.shiftright(b, 32), F.array(a.bitwiseAND(place).cast("int"), b.bitwiseAND(place).cast("int"))))
    return F.array_distinct(F.flatten(F.filter(both, lambda x: x.isNotNull())))


def _windows(words: Column, places: Column) -> Column:
    """``(g, i)``: the words of the windows at ``places``, sorted by them."""
    return F.sort_array(F.transform(places, lambda i: F.struct(
        F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("g"), i.alias("i"))))


def _repeated(windows: Column) -> Column:
    """Sorted places of the windows whose words stand in another window too."""
    less = F.greatest(F.size(windows) - 1, F.lit(0))
    both = F.zip_with(F.slice(windows, 1, less), F.slice(windows, 2, less),
                      lambda a, b: F.when(a["g"] == b["g"], F.array(a["i"], b["i"])))
    return F.sort_array(F.array_distinct(F.flatten(F.filter(both, lambda x: x.isNotNull()))))


def _covered(places: Column) -> Column:
    """Words inside the three-word windows that start at ``places``."""
    after = F.slice(places, 2, F.greatest(F.size(places), F.lit(1)))
    steps = F.zip_with(places, after, lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``ord, h`` and the measures of each row of ``docs``, in the scan stage.

    ``n_words``; ``word_chars``, code points inside words; ``n_symbols``;
    ``n_dup_lines``, lines with a word that equal an earlier line;
    ``n_repeat_words``, words inside three-word windows that occur twice or more
    (windows that share a hash are compared by their words).
    """
    text = clean_text(docs[text_col])
    out = docs.select(ordinal(docs[id_col]).alias("ord"), text_hash(docs[text_col]).alias("h"), text.alias("text"))
    out = out.withColumns({
        "w": _words(F.col("text")),
        "lines": F.filter(F.split("text", "\n"), _has_word),
        "n_symbols": (F.size(F.split("text", SYMBOLS)) - 1).cast("long"),
    })
    out = out.withColumns({
        "n_words": F.size("w").cast("long"),
        "word_chars": F.length(F.array_join("w", "")).cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "hashes": F.transform("w", lambda w: F.xxhash64(w)),
    })
    out = out.withColumn("hashed", _hashed(F.col("hashes")))
    out = out.withColumn("alike", _pairs(F.col("hashed")))
    out = out.withColumn("windows", F.when(F.size("alike") > 0, _windows(F.col("w"), F.col("alike"))))
    out = out.withColumn("places", F.when(F.size("alike") > 0, _repeated(F.col("windows"))))
    return out.select("ord", "h", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      F.when(F.size("places") > 0, _covered(F.col("places"))).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"))


def _host(docs: DataFrame, host_col: str | None) -> Column:
    host = docs[host_col].cast("string") if host_col else F.lit("")
    return F.xxhash64(host.isNull(), host)


def line_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str | None = "source") -> DataFrame:
    """``ord, h, g, pos, l1, l2, words``: each line with a word, hashed together with its host ``g``."""
    rows = docs.select(ordinal(docs[id_col]).alias("ord"), text_hash(docs[text_col]).alias("h"),
                       _host(docs, host_col).alias("g"),
                       F.posexplode(F.split(clean_text(docs[text_col]), "\n")).alias("pos", "line"))
    rows = rows.withColumn("line", _normal(F.col("line"))).where("line != ''")
    return rows.select("ord", "h", "g", "pos", F.xxhash64("g", "line").alias("l1"), F.xxhash64("line", "g", F.lit(1)).alias("l2"),
                       F.size(F.split("line", " ")).alias("words"))


def frequent_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str | None = "source",
                   max_docs: int = MAX_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """``l1, l2, n_docs`` of the lines above both limits, stored."""
    rows = line_rows(docs, id_col, text_col, host_col)
    counts = rows.groupBy("g", "l1", "l2").agg(F.count_distinct("h").alias("n_docs")).where(F.col("n_docs") > max_docs)
    salt = F.explode(F.sequence(F.lit(0), F.lit(_HOST_SALTS - 1)))
    worded = docs.where(_has_word(clean_text(docs[text_col]))).select(_host(docs, host_col).alias("g"), text_hash(docs[text_col]).alias("h"))
    hosts = worded.groupBy("g").agg(F.count_distinct("h").alias("host_docs")).withColumn("salt", salt)
    several = counts.withColumn("salt", F.pmod("l1", F.lit(_HOST_SALTS)).cast("int")).join(hosts, ["g", "salt"])
    return stored(several.where(F.col("n_docs") > max_share * F.col("host_docs")).select("l1", "l2", "n_docs"), "frequent_lines")


def removed_lines(rows: DataFrame, frequent: DataFrame) -> DataFrame:
    """``ord, h, removed, removed_words`` of the documents that hold frequent lines; ``removed`` has their line numbers, from 0."""
    places = frequent.agg(F.sum("n_docs")).first()[0] or 0
    is_heavy = F.col("n_docs") * HEAVY > places
    heavy = frequent.where(is_heavy).select("l1", "l2", F.lit(True).alias("heavy"))
    tagged = rows.drop("g").join(F.broadcast(heavy), ["l1", "l2"], "left")
    hits = tagged.where("heavy").unionByName(
        tagged.where("heavy IS NULL").join(frequent.where(~is_heavy).select("l1", "l2"), ["l1", "l2"], "left_semi"))
    once = hits.groupBy("ord", "h", "pos").agg(F.max("words").alias("words"))  # rows that repeat id and text count once
    return once.groupBy("ord", "h").agg(F.sort_array(F.collect_list("pos")).alias("removed"), F.sum("words").alias("removed_words"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str | None = "source",
          max_docs: int = MAX_DOCS, max_share: float = MAX_SHARE, min_left: float = MIN_LEFT) -> DataFrame:
    """A row per document row: ``ord, h``, the measures, ``removed``, ``removed_words``, ``base_failed``, ``depleted``, ``kept``."""
    frequent = frequent_lines(docs, id_col, text_col, host_col, max_docs, max_share)
    gone = removed_lines(line_rows(docs, id_col, text_col, host_col), frequent)
    out = measure(docs, id_col, text_col).join(gone, ["ord", "h"], "left")
    n, lost = F.col("n_words"), F.coalesce(F.col("removed_words"), F.lit(0))
    out = out.withColumns({
        "removed": F.coalesce("removed", F.array().cast("array<int>")),
        "removed_words": lost,
        "base_failed": (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n),
        "depleted": (n - lost) < min_left * n,
    })
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))


def cleaned(docs: DataFrame, judged: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that ``judged`` keeps, their frequent lines taken out of the text; columns as in ``docs``."""
    o, h, cut, lines = (free_name(docs, c) for c in ("_ord", "_h", "_cut", "_lines"))
    verdicts = judged.where("kept").select(F.col("ord").alias(o), F.col("h").alias(h), F.col("removed").alias(cut)).dropDuplicates([o, h])
    marked = docs.withColumns({o: ordinal(docs[id_col]), h: text_hash(docs[text_col])}).join(verdicts, [o, h])
    marked = marked.withColumn(lines, F.split(clean_text(F.col(f"`{text_col}`")), "\n"))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(cut))
    rest = F.array_join(F.transform(left, lambda i: F.get(F.col(lines), i)), "\n")
    text = F.when(F.size(cut) > 0, rest).otherwise(F.col(f"`{text_col}`"))
    return marked.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def as_contract(judged: DataFrame) -> DataFrame:
    return judged.select(original_id().alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", F.col("removed_words").cast("long").alias("n_frequent_words"))
