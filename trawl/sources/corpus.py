"""Readers of the three external inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl import schemas
from trawl.operators.joins import lookup_join


def balanced(df: DataFrame, key: str) -> DataFrame:
    """An input that would be scanned by fewer tasks than there are cores, spread over all cores.

    A file of a few megabytes can be a single row group, which one task would process alone.
    An input with tasks enough is not moved. No plan relies on the exchange.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, F.xxhash64(key))


def read_corpus(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parquet documents ``(id, title, text, anchor_text)``; a glob is fine."""
    corpus = spark.read.schema(schemas.CORPUS).parquet(*([path] if isinstance(path, str) else path))
    return balanced(corpus, "id")


def read_pageviews(spark: SparkSession, path: str | list[str], positions: bool = False) -> DataFrame:
    """Page-view log lines ``(value)``; the suffix tells the compression, and bz2 is split.

    With ``positions`` each line has its ``position``, which orders lines by file, and by their place within it.
    """
    lines = spark.read.text(path)
    return lines.select("value", _position().alias("position")) if positions else lines


def _position() -> Column:
    """Of a row read from files: the file, the beginning of the split, and the row's place in the task that reads the split.

    A split is read by one task from its beginning to its end, so within it rows are numbered as they stand there.
    """
    return F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
                    F.monotonically_increasing_id().alias("row"))


# What ends a list of ids in a judgement file. Within a string a quote is escaped, so this stands at the end of lists
# only, unless a backslash is before it.
LIST_END = '"]'
ENDS_ESCAPED = r"(?s)(^|[^\\])(\\\\)*\\$"


def read_qrels(spark: SparkSession, path: str | list[str], one_object_per_line: bool = False) -> DataFrame:
    """``(query, doc_id)`` from JSON objects that map a query to its relevant ids, as strings.

    A file holds one object or several, on lines of their own or not; ``one_object_per_line`` is no longer needed. It is cut behind each list of ids, so that a large object is read by
    many tasks, a few entries a row; a file in which a query has an escaped quote before a bracket is read whole, as are
    lists of numbers without any string. Ids that are no integers are dropped.
    """
    pieces = spark.read.option("lineSep", LIST_END).text(path).select("value", F.col("_metadata.file_path").alias("path"))
    whole = pieces.where(F.col("value").rlike(ENDS_ESCAPED)).select("path").distinct()
    # One row per odd file.
    odd = [r["path"] for r in whole.collect()]
    opened = F.regexp_replace("value", r"^[\s}]*[\s{,]*", "{")
    objects = pieces.where(~F.col("path").isin(odd)).select(F.concat(opened, F.lit(LIST_END + "}")).alias("value"))
    if odd:
        objects = objects.unionByName(spark.read.text(odd, wholetext=True))
    per_query = objects.select(F.explode(F.from_json("value", schemas.QRELS_JSON)).alias("query", "ids"))
    return (per_query.select("query", F.explode("ids").alias("doc_id"))
            .select("query", F.col("doc_id").try_cast("bigint").alias("doc_id")).where("doc_id IS NOT NULL"))


def match_qrels(qrels: DataFrame, queries: DataFrame) -> DataFrame:
    """``(query_id, doc_id)``: judgements by query text joined to ``queries (query_id, query)``."""
    return lookup_join(qrels, queries, "query", ["doc_id"]).select("query_id", "doc_id")
