"""Token counts of whole texts through a cache of digests."""

from __future__ import annotations

import hashlib

import tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import read, text_function
from trawl.llm.tokens import vocabulary, word_tokenizer
from trawl.operators.joins import lookup_join
from trawl.sources.shared import shared_path, write_shared

import pyarrow as pa

CACHE = "tokenizer string, digest binary, n_tokens bigint"
LIMIT = 2048


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer's file and library version: counts of another one are never used."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + tokenizers.__version__.encode()).hexdigest()


def content_digest(text):
    """SHA-256 of the text with each run of ASCII white space made one space and the ends trimmed.

    The tokenizer does the same before it counts, so texts that differ only there share a count.
    """
    one_space = F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t\n\x0B\f\r]+", " ")
    return F.unhex(F.sha2(F.trim(one_space), 256))


def cached(spark, path: str, version: str) -> DataFrame:
    """The stored counts of a tokenizer version; empty if nothing has been stored yet."""
    try:
        stored = spark.read.schema(CACHE).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], CACHE)
    return stored.where(F.col("tokenizer") == version).select("digest", "n_tokens")


def counter(path: str):
    def count(texts: list[str]) -> list:
        return [[len(ids) // 4 for ids in word_tokenizer(path).ids(texts)]]
    return text_function(count, "n_tokens bigint", ["n_tokens"], [pa.int64()])


def token_counts(docs: DataFrame, cache_path: str, tokenizer_path: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)``, one row per row of ``docs``.

    Digests of the contents are looked up in the cache at ``cache_path`` under the digest of
    the tokenizer. Of each digest that is missing one text is encoded, and its count is
    appended to the cache, so a later call with the same folder encodes only what is new.
    Then all rows take their counts from the cache.

    Null and empty texts have 0 bytes and 0 tokens. Texts are counted whole, whatever their
    length. Repeated rows and copies each keep their row and share one count; null and
    repeated ids are kept. An empty table gives an empty result. Other columns are ignored.
    """
    spark, path = docs.sparkSession, tokenizer_path or vocabulary()
    version = tokenizer_version(path)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    keys = write_shared(
        texts.select("id", content_digest(F.col("text")).alias("digest"),
                     F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes")), "digests")
    wanted = keys.groupBy("digest").agg(F.min("id").alias("id"))
    missing = wanted.join(cached(spark, cache_path, version), "digest", "left_anti")
    to_encode = (texts.withColumn("digest", content_digest(F.col("text"))).alias("t")
                 .join(missing.alias("m"),
                       (F.col("t.digest") == F.col("m.digest")) & F.col("t.id").eqNullSafe(F.col("m.id")),
                       "left_semi"))
    (to_encode.select(F.lit(version).alias("tokenizer"), "digest", counter(path)("text").alias("c"))
     .select("tokenizer", "digest", "c.n_tokens").write.mode("append").parquet(cache_path))
    # A row repeated with its id, or two jobs at once, may have stored a digest twice.
    counts = cached(spark, cache_path, version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    counted = lookup_join(keys, counts, "digest", ["id"], "left")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                          (F.col("n_tokens") > limit).alias("over_limit"))


def op3_token_counts(spark, sf_dir):
    """Counts of all documents, from a new cache, so that every distinct text is encoded here."""
    return token_counts(read(spark, sf_dir, "documents"), shared_path(spark, "token-cache"))
