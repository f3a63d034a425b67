"""Schemas of the tables that go in and out of the engine."""

from pyspark.sql import types as T

LINK = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("text", T.StringType()),
])

CORPUS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("anchor_text", T.ArrayType(LINK)),
])

POSTINGS = T.StructType([
    T.StructField("term", T.StringType()),
    T.StructField("doc_id", T.LongType()),
    T.StructField("tf", T.IntegerType()),
])

TERM_STATS = T.StructType([
    T.StructField("term", T.StringType()),
    T.StructField("df", T.LongType()),
    T.StructField("term_total", T.LongType()),
])

INDEX_INFO = T.StructType([
    T.StructField("min_df", T.LongType()),
    T.StructField("max_df", T.LongType()),
    T.StructField("n_buckets", T.IntegerType()),
    T.StructField("complete", T.BooleanType()),
    T.StructField("block_docs", T.LongType()),
    T.StructField("by_term", T.BooleanType()),
    T.StructField("lengths", T.BooleanType()),
    T.StructField("term_buckets", T.IntegerType()),
])

LENGTHS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("length", T.LongType()),
])

BLOCKS = T.StructType([
    T.StructField("term", T.StringType()),
    T.StructField("block", T.LongType()),
    T.StructField("n", T.LongType()),
    T.StructField("top_tf", T.IntegerType()),
])

MANIFEST = T.StructType([
    T.StructField("segment", T.StringType()),
    T.StructField("place", T.IntegerType()),
])

PAGERANK = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("pagerank", T.DoubleType()),
])

PAGEVIEWS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("views", T.LongType()),
])

TITLES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StringType()),
])

QRELS_JSON = T.MapType(T.StringType(), T.ArrayType(T.StringType()))
