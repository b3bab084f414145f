"""Headerless tab-separated files: the on-disk format of the original.

Readers always take an explicit schema (no inference) and apply pandas'
default missing-value tokens (S10). A missing id stays NULL where the original
allows it; anything else that isn't a number ends the job with file, place and
text of the record. Tables with text columns may hold quoted newlines and are cut into
records by ``records.read_records``, in splits; tables of ids are read as lines.

Where row order carries meaning the reader adds ``seq``: for triples file, split
start and position inside the split, for records file and line number. Neither
needs a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise import schemas
from shelfwise.functions.text import na_to_null
from shelfwise.operators.ranking import rank_within_groups
from shelfwise.sources.records import read_records


def _number(part: Column, kind: str, bad: Column, required: bool = True) -> Column:
    """The id in ``part``; what isn't one raises the error ``bad``. A missing one is NULL unless ``required``.

    Columns that the original infers hold whole floats where values are missing. The pattern is tried only
    where a whole number's plain cast fails.
    """
    given = part if required else na_to_null(part)
    value = F.regexp_replace(given, r"\.0*$", "").try_cast(kind)
    if kind in ("bigint", "int"):
        value = F.coalesce(given.try_cast(kind), value)
    error = F.raise_error(bad).cast(kind)
    return F.coalesce(value, error if required else F.when(given.isNotNull(), error))


def _typed(rows: DataFrame, fields: Column, where: Column, schema: T.StructType, required: Sequence[str], *keep: str) -> DataFrame:
    """The columns of ``schema`` from an array of fields; too many fields are an error, missing ones are NULL.

    The array is generated as one row of parts, so that a line is cut once, whatever
    is asked of its columns (a filter on one would otherwise cut it again for each mention).
    """
    n = len(schema.fields)
    rows = rows.select("*", F.explode(F.array(fields)).alias("_fields"))
    fields = F.col("_fields")
    bad = F.concat(F.lit("malformed line in "), where, F.lit(": "), F.array_join(fields, "\t"))
    out = []
    for i, f in enumerate(schema.fields):
        part = F.when(F.size(fields) > n, F.raise_error(bad).cast("string")).otherwise(F.get(fields, F.lit(i)))
        if isinstance(f.dataType, T.StringType):
            out.append(na_to_null(part).alias(f.name))
        else:
            out.append(_number(part, f.dataType.simpleString(), bad, f.name in required).alias(f.name))
    return rows.select(*out, *keep)


def read_table(spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str] = (), with_seq: bool = False,
               skip_lines: int = 0) -> DataFrame:
    """Headerless TSV with an explicit schema, quoted newlines and all; ``with_seq`` adds ``seq`` (file, line).

    The first ``skip_lines`` lines of each file are left out. A column in ``required`` must hold a number.
    """
    rows = read_records(spark, path)
    if skip_lines:
        rows = rows.where(F.col("line") > skip_lines)
    rows = rows.withColumn("seq", F.struct("file", "line"))
    where = F.concat("file", F.lit(", line "), F.col("line").cast("string"))
    return _typed(rows, F.col("fields"), where, schema, required, *(["seq"] if with_seq else []))


def read_ids(spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str] = ()) -> DataFrame:
    """A table of numbers only, read as lines; blank ones are skipped, quotes around a number are dropped."""
    lines = _raw_lines(spark, path).where(F.trim("line") != "")
    parts = F.split("line", "\t")
    bare = F.transform(parts, lambda x: F.regexp_replace(x, '^"(.*)"$', "$1"))
    fields = F.when(F.contains(F.col("line"), F.lit('"')), bare).otherwise(parts)
    return _typed(lines, fields, F.col("file"), schema, required)


def read_interactions(spark: SparkSession, path: str) -> DataFrame:
    """Missing users, items and labels are NULL, other text is an error."""
    return read_ids(spark, path, schemas.INTERACTIONS)


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    """S1 of what ``write_splits`` wrote: interactions with the ``split`` of their folder."""
    lines = spark.read.schema("value string, split string").text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), "split").where(F.trim("line") != "")
    return _typed(lines, F.split("line", "\t"), F.col("file"), schemas.INTERACTIONS, (), "split")


def read_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """Typed as integers, so nothing may be missing."""
    return read_ids(spark, path, schemas.INTERACTIONS, required=schemas.INTERACTIONS.names)


def read_item_features(spark: SparkSession, path: str) -> DataFrame:
    """S4."""
    return read_table(spark, path, schemas.ITEM_FEATURES, required=["item_id"])


def read_examples(spark: SparkSession, path: str, with_seq: bool = False) -> DataFrame:
    """S5; ``seq`` is the order of the rows in the files."""
    return read_table(spark, path, schemas.EXAMPLES, with_seq=with_seq)


def read_item_prop(spark: SparkSession, path: str, with_seq: bool = True) -> DataFrame:
    """Triples; with ``with_seq`` a ``seq`` that sorts in triple order (a struct: file, split, place)."""
    if not with_seq:
        return read_ids(spark, path, schemas.ITEM_PROP, required=schemas.ITEM_PROP.names)
    lines = _raw_lines(spark, path).withColumn("seq", F.struct("file", "_blk", "_mid")).where(F.trim("line") != "")
    return _typed(lines, F.split("line", "\t"), F.col("file"), schemas.ITEM_PROP, schemas.ITEM_PROP.names, "seq")


def _raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with ``file, _blk, _mid``, which sort in file order."""
    return spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_blk"),
        F.monotonically_increasing_id().alias("_mid"),
    )


def read_entities(spark: SparkSession, path: str, skip_rows: int = 2) -> DataFrame:
    """S3: ``id, prop, seq`` with the first two lines of each file discarded.

    ``seq``, file and line number, is the entity order used to pick "first" values (D2).
    """
    return read_table(spark, path, schemas.ENTITIES, required=["id"], with_seq=True, skip_lines=skip_rows)


def _decoded(path):
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def run_name(file: Column) -> Column:
    """The ``run_name=<run>`` folder a file sits in, else the file's name without its suffix."""
    # Spark's file paths are URL-encoded, and its partition folders escape names once more.
    folder = F.nullif(F.regexp_extract(_decoded(file), r"/run_name=([^/]+)/[^/]*$", 1), F.lit(""))
    return F.coalesce(_decoded(folder), F.regexp_extract(_decoded(file), r"([^/]+?)(?:\.(?:txt|tsv|csv))?$", 1))


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """``run_name, user_id, item_id, rank`` from ``user<TAB>item`` files.

    ``rank`` is the position of the line among the same user's lines of the
    same run, in file order (files of a run in name order), so one folder can hold every run.
    """
    rows = read_table(spark, path, schemas.PREDICTIONS, required=schemas.PREDICTIONS.names, with_seq=True)
    rows = rows.select(run_name(F.col("seq.file")).alias("run_name"), "user_id", "item_id", "seq")
    ranked = rank_within_groups(rows, ["run_name", "user_id"], ["seq"], rank_col="rank")
    return ranked.select("run_name", "user_id", "item_id", "rank")


_WRITE_OPTIONS = {
    "sep": "\t", "header": "false", "quote": '"', "escape": '"', "nullValue": "", "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1: headerless TSV; NULL and '' both written as an empty field."""
    df.write.mode(mode).options(**_WRITE_OPTIONS).csv(path)


def write_splits(df: DataFrame, path: str, order: Sequence[str] = ("user_id", "item_id")) -> None:
    """Every split in one job, as ``split=<name>`` folders whose files hold ascending ranges of ``order``.

    One range partitioning by (split, order): a split's rows lie in neighbouring
    ranges, so a file belongs to one range of one split.
    """
    ordered = df.repartitionByRange("split", *order).sortWithinPartitions("split", *order)
    (ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("split")
     .options(**_WRITE_OPTIONS).csv(path))


def write_ranked_predictions(df: DataFrame, path: str, partition_by_run: bool = True) -> None:
    """K3/K4: ``user_id<TAB>item_id`` lines in rank order, one folder per run.

    Range partitioning by (run, user, rank) + a per-partition sort gives ordered
    part files without a single-task global sort. An existing run folder is
    replaced (dynamic partition overwrite), other runs are left alone.
    """
    ordered = df.repartitionByRange("run_name", "user_id", "rank").sortWithinPartitions("run_name", "user_id", "rank")
    writer = (
        ordered.select("run_name", "user_id", "item_id").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("sep", "\t").option("header", "false")
    )
    if partition_by_run:
        writer = writer.partitionBy("run_name")
    writer.csv(path)
