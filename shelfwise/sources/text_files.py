"""Item texts as one file per item, and as a table.

A folder with one ``<item_id>.text`` file per item is read with the
``binaryFile`` source (whole file per row, decoded as UTF-8, id = file stem).
Zero-length files are skipped by Spark, which matches the original: an empty
text is dropped before use anyway. Writing goes to one parquet table instead
of one file per item (millions of tiny files do not scale).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.text import file_stem


def read_text_folder(spark: SparkSession, path: str, glob: str = "*.text") -> DataFrame:
    """``item_id, item_text`` from a folder of per-item text files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select(
        file_stem(F.col("path")).cast("long").alias("item_id"),
        F.decode(F.col("content"), "UTF-8").alias("item_text"),
    )


def write_texts(texts: DataFrame, path: str) -> None:
    texts.select("item_id", "item_text").write.mode("overwrite").parquet(path)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("item_id", "item_text")
