"""Explicit schemas of every table the operators read or write. No inference."""

from pyspark.sql import types as T

INTERACTIONS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("label", T.IntegerType()),
])

ITEM_PROP = T.StructType([
    T.StructField("item_id", T.LongType()),
    T.StructField("id", T.LongType()),
    T.StructField("type", T.IntegerType()),
])

ENTITIES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("prop", T.StringType()),
])

FEATURE_COLUMNS = ("author", "genre", "series", "publisher", "subject")

ITEM_FEATURES = T.StructType(
    [T.StructField("item_id", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in FEATURE_COLUMNS]
)

EXAMPLES = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("label", T.IntegerType()),
    T.StructField("user_genres", T.StringType()),
    T.StructField("item_genre", T.StringType()),
])

TEXTS = T.StructType([
    T.StructField("item_id", T.LongType()),
    T.StructField("item_text", T.StringType()),
])

PREDICTIONS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
])

RANKED_PREDICTIONS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("rank", T.LongType()),
])

SCORES = T.StructType([
    T.StructField("run_name", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("score", T.DoubleType()),
])

#: A scorer's log: a candidate may have several scores, the last line counts.
SCORE_LOG = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("score", T.DoubleType()),
])

RUNS = T.StructType([
    T.StructField("run_name", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("template", T.StringType()),
    T.StructField("word_neg", T.StringType()),
    T.StructField("word_pos", T.StringType()),
])
