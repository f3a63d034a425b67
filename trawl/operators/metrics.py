"""Retrieval quality of ranked runs.

Inputs are ``queries (query_id)``, ``run (query_id, rank, doc_id)`` with ranks counted from
1 without gaps, and ``qrels (query_id, doc_id)``. Every query gets a row, whether or not
it has results or judgements.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions.scoring import round3

PRECISION_K, F1_K, AP_K = 5, 30, 40


def _judged(queries: DataFrame, run: DataFrame, qrels: DataFrame, k: int) -> DataFrame:
    """Per query: ``relevant``, their number, and ``top``, the ranks up to k with their hits.

    The three tables are stacked and grouped rather than joined: once by query and document,
    where judgements meet ranks, and once by query. Only ranks up to k are collected.
    """
    stacked = (queries.select("query_id", F.lit(None).cast("bigint").alias("doc_id"),
                              F.lit(None).cast("int").alias("rank"), F.lit(0).alias("judged"), F.lit(1).alias("asked"))
               .unionByName(run.where(F.col("rank") <= k).select(
                   "query_id", "doc_id", "rank", F.lit(0).alias("judged"), F.lit(0).alias("asked")))
               .unionByName(qrels.select("query_id", "doc_id", F.lit(None).cast("int").alias("rank"),
                                         F.lit(1).alias("judged"), F.lit(0).alias("asked"))))
    met = stacked.groupBy("query_id", "doc_id").agg(
        F.max("judged").alias("judged"), F.max("asked").alias("asked"), F.collect_list("rank").alias("ranks"))
    hits = F.transform("ranks", lambda r: F.struct(r.alias("rank"), F.col("judged").alias("hit")))
    return (met.groupBy("query_id")
            .agg(F.max("asked").alias("asked"), F.sum("judged").alias("relevant"),
                 F.sort_array(F.flatten(F.collect_list(F.when(F.size("ranks") > 0, hits)))).alias("top"))
            .where("asked = 1"))


def _first(k: int) -> Column:
    return F.filter("top", lambda r: r["rank"] <= k)


def _hits(k: int) -> Column:
    return F.size(F.filter("top", lambda r: (r["rank"] <= k) & (r["hit"] == 1)))


def _precision(k: int) -> Column:
    """Hits over the length of the list cut at k, which may be shorter than k."""
    return F.when(F.size(_first(k)) == 0, F.lit(0.0)).otherwise(_hits(k) / F.size(_first(k)))


def _recall(k: int) -> Column:
    return F.when(F.col("relevant") == 0, F.lit(1.0)).otherwise(_hits(k) / F.col("relevant"))


def _harmonic(a: Column, b: Column) -> Column:
    return F.when((a == 0) | (b == 0), F.lit(0.0)).otherwise(2.0 / (1.0 / a + 1.0 / b))


def precision_at_k(queries: DataFrame, run: DataFrame, qrels: DataFrame, k: int) -> DataFrame:
    """``(query_id, precision)``, rounded to 3 places like every metric here."""
    return _judged(queries, run, qrels, k).select("query_id", round3(_precision(k)).alias("precision"))


def recall_at_k(queries: DataFrame, run: DataFrame, qrels: DataFrame, k: int) -> DataFrame:
    """``(query_id, recall)``; 1.0 if nothing is relevant."""
    return _judged(queries, run, qrels, k).select("query_id", round3(_recall(k)).alias("recall"))


def f1_at_k(queries: DataFrame, run: DataFrame, qrels: DataFrame, k: int) -> DataFrame:
    """``(query_id, f1)``: harmonic mean of the rounded precision and recall."""
    return evaluate(queries, run, qrels, precision_k=k, f1_k=k).select("query_id", "f1")


def average_precision(queries: DataFrame, run: DataFrame, qrels: DataFrame, k: int = AP_K) -> DataFrame:
    """``(query_id, average_precision)``: mean precision at the hits, over the hits found."""
    return (evaluate(queries, run, qrels, ap_k=k).select("query_id", "average_precision"))


def results_quality(queries: DataFrame, run: DataFrame, qrels: DataFrame) -> DataFrame:
    """``(query_id, quality)``: harmonic mean of the rounded precision@5 and F1@30."""
    return evaluate(queries, run, qrels).select("query_id", "quality")


def evaluate(queries: DataFrame, run: DataFrame, qrels: DataFrame, precision_k: int = PRECISION_K,
             f1_k: int = F1_K, ap_k: int = AP_K) -> DataFrame:
    """All metrics in one pass: ``(query_id, precision, recall, f1, average_precision, quality)``.

    ``recall`` is the one at ``f1_k`` that enters F1.
    """
    hit_ranks = F.transform(F.filter("top", lambda r: (r["hit"] == 1) & (r["rank"] <= ap_k)), lambda r: r["rank"])
    at_hits = F.transform("hit_ranks", lambda rank, i: (i + 1) / rank)
    total = F.aggregate(at_hits, F.lit(0.0), lambda a, x: a + x)
    judged = _judged(queries, run, qrels, max(precision_k, f1_k, ap_k))
    rounded = judged.select(
        "query_id",
        round3(_precision(precision_k)).alias("precision"),
        round3(_precision(f1_k)).alias("_precision_f1"),
        round3(_recall(f1_k)).alias("recall"),
        hit_ranks.alias("hit_ranks"))
    with_f1 = rounded.withColumn("f1", round3(_harmonic(F.col("_precision_f1"), F.col("recall"))))
    mean = F.when(F.size("hit_ranks") == 0, F.lit(0.0)).otherwise(total / F.size("hit_ranks"))
    return with_f1.select(
        "query_id", "precision", "recall", "f1", round3(mean).alias("average_precision"),
        round3(_harmonic(F.col("precision"), F.col("f1"))).alias("quality"))
