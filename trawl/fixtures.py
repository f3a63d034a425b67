"""Engine inputs derived from the driver's tables. ``oracle.py`` has the same rules in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.functions.text import term_frequencies, terms
from trawl.operators.joins import spread_join, tokens_fit_broadcast
from trawl.operators.ranking import query_terms
from trawl.sources.corpus import balanced
from trawl.sources.shared import write_shared

# The rare-term cut of the two queries whose feature is a cut.
MIN_DF = 5
TITLE_PATTERN = "<title>([^<]*)</title>"
LINK_PATTERN = '<a href="([^"]*)">([^<]*)</a>'
MARKUP_PATTERN = "(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>"


def table(spark: SparkSession, sf_dir: str, name: str, key: str | None = None) -> DataFrame:
    """A driver table, spread over all cores by ``key`` if it is given and few tasks would scan it."""
    read = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return read if key is None else balanced(read, key)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, text)``"""
    return table(spark, sf_dir, "documents", "doc_id").select(F.col("doc_id").alias("id"), "text")


def _page_columns() -> list[Column]:
    return [F.col("page_id").alias("id"),
            F.regexp_extract("html", TITLE_PATTERN, 1).alias("title"),
            F.regexp_replace("html", MARKUP_PATTERN, " ").alias("text")]


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, title, text)``"""
    return table(spark, sf_dir, "pages", "page_id").select(*_page_columns())


def raw_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(src, href, text)``, one row per link of a page."""
    part = lambda group: F.regexp_extract_all("html", F.lit(LINK_PATTERN), F.lit(group))
    found = table(spark, sf_dir, "pages", "page_id").select(
        F.col("page_id").alias("src"), F.explode(F.arrays_zip(part(1).alias("href"), part(2).alias("text"))).alias("a"))
    return found.select("src", "a.href", "a.text")


def links_out_of_corpus(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Links of the corpus without every fifth page, to any page, and the ``(id)`` of the corpus."""
    inside = F.col("src") % 5 != 0
    docs = pages(spark, sf_dir).select("id").where(F.col("id") % 5 != 0)
    return links(spark, sf_dir).where(inside), docs


def repeated_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, title)`` with ten pages to an id."""
    return pages(spark, sf_dir).select((F.col("id") % F.lit(10)).alias("id"), "title")


def odd_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queries, and of each one that is empty, one of stopwords and one with an unknown term beside its own."""
    asked = queries(spark, sf_dir)
    shapes = [F.col("query"), F.lit(""), F.lit("the of and"), F.concat(F.lit("zzzunknown "), F.col("query"))]
    odd = F.explode(F.array(*[F.struct((F.col("query_id") * 4 + n).alias("query_id"), q.alias("query"))
                              for n, q in enumerate(shapes)])).alias("q")
    return asked.select(odd).select("q.*")


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(src, dst, text)``; a link leads to the first page that carries the same address.

    An address may be on a large share of all pages.
    """
    # Pages are parsed once: counts, targets and rows read the same columns of one exchange.
    found = raw_links(spark, sf_dir).where("href IS NOT NULL").repartition("src")
    targets = found.groupBy("href").agg(F.min(F.struct("src", "text"))["src"].alias("dst"))
    loads = found.groupBy("href").agg(F.count_if(F.col("text").isNotNull()).alias("load"))
    return spread_join(found, targets, ["href"], loads, ["src", "text"]).select("src", "dst", "text")


def nested_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, title, text, anchor_text)`` with links numbered by a hash of their address."""
    part = lambda group: F.regexp_extract_all("html", F.lit(LINK_PATTERN), F.lit(group))
    numbered = F.zip_with(part(1), part(2), lambda href, text: F.struct(
        F.conv(F.substring(F.md5(href), 1, 8), 16, 10).cast("bigint").alias("id"), text.alias("text")))
    return table(spark, sf_dir, "pages", "page_id").select(*_page_columns(), numbered.alias("anchor_text"))


def pageview_lines(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """``(value)`` and further columns, where error events have a first field that is no id."""
    first = F.when(F.col("event_type") == "error", F.lit("en.wikipedia")).otherwise(F.col("user_id").cast("string"))
    return table(spark, sf_dir, "events").select(
        F.concat_ws(" ", first, "event_type", F.floor("value").cast("string")).alias("value"), *more)


def queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def qrels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(query_id, doc_id)``: the documents that hold the query's rarest known term."""
    asked = queries(spark, sf_dir)
    wanted = query_terms(asked)
    counted = term_frequencies(documents(spark, sf_dir), "id", "text")
    small = tokens_fit_broadcast(asked, "query")
    if small:
        counted = counted.join(F.broadcast(wanted.select("term")), "term", "left_semi")
    counted = write_shared(counted, "judged-terms")
    known = counted.groupBy("term").agg(F.count_if(F.col("tf") > 0).alias("df")).join(wanted, "term")
    rarest = known.groupBy("query_id").agg(F.min(F.struct("df", "term")).alias("r")).select("query_id", "r.df", "r.term")
    if small:
        found = counted.join(F.broadcast(rarest), "term")
    else:
        loads = rarest.groupBy("term").agg((F.max("df").cast("double") * F.count("*")).alias("load"))
        found = spread_join(counted, rarest, ["term"], loads, ["doc_id"])
    return found.select("query_id", "doc_id")


def tokenised_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, tokens)`` with ids below those of ``documents``."""
    return table(spark, sf_dir, "benchmark").select(
        (-1 - F.col("item_id")).alias("doc_id"), terms("text").alias("tokens"))
