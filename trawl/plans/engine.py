"""The whole pipeline over one corpus: build and save, load, search, evaluate."""

from __future__ import annotations

import time
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.operators import links as graph
from trawl.operators import metrics, ranking, signals
from trawl.operators.indexing import Index, build_anchor_index, build_index
from trawl.sources import store
from trawl.sources.shared import write_shared


@dataclass(frozen=True)
class Engine:
    """Three indices and three signals. ``anchor`` and the signals may be absent."""

    body: Index
    title: Index
    anchor: Index | None
    n_docs: int
    pagerank: DataFrame | None = None
    pageviews: DataFrame | None = None
    titles: DataFrame | None = None
    stopwords: Iterable[str] | None = None

    @classmethod
    def build(cls, corpus: DataFrame, path: str, pageview_lines: DataFrame | None = None,
              links: DataFrame | None = None, stopwords: Iterable[str] | None = None,
              min_df: int = 0, max_df: int | None = None, n_buckets: int = store.N_BUCKETS,
              iterations: int = graph.ITERATIONS, mode: str = "error") -> Engine:
        """Index ``corpus (id, title, text, anchor_text)``, save all tables under ``path``, load them.

        ``links (src, dst, text)`` replaces the links in ``anchor_text`` if given. No terms are
        cut unless ``min_df`` (of the body) or ``max_df`` is given.
        """
        if links is None:
            links = graph.links_of(corpus)
        cut = {"stopwords": stopwords, "max_df": max_df}
        for name, index in (("body", build_index(corpus, "text", min_df=min_df, **cut)),
                            ("title", build_index(corpus, "title", **cut)),
                            ("anchor", build_anchor_index(links, **cut))):
            store.save_index(index, f"{path}/{name}", n_buckets, mode=mode)
        ranks = graph.pagerank(graph.link_edges(links), corpus.select("id"), iterations=iterations)
        views = None
        if pageview_lines is not None:
            views = signals.pageview_map(signals.parse_pageviews(pageview_lines))
        store.save_signals(path, ranks, views, signals.title_map(corpus), mode)
        return cls.load(corpus.sparkSession, path, stopwords)

    @classmethod
    def load(cls, spark: SparkSession, path: str, stopwords: Iterable[str] | None = None,
             n_docs: int | None = None) -> Engine:
        titles = store.load_signal(spark, path, "titles")
        if n_docs is None:
            n_docs = titles.count()
        return cls(store.load_index(spark, f"{path}/body"), store.load_index(spark, f"{path}/title"),
                   store.load_index(spark, f"{path}/anchor", missing_ok=True), n_docs,
                   store.load_signal(spark, path, "pagerank"), store.load_signal(spark, path, "pageviews"),
                   titles, stopwords)

    def search(self, queries: DataFrame, k: int = ranking.TOP_K) -> DataFrame:
        return ranking.search(self.body, self.title, self.anchor, queries, self.n_docs, self.pagerank,
                              self.pageviews, self.titles, k, self.stopwords)

    def search_body(self, queries: DataFrame, k: int = ranking.TOP_K) -> DataFrame:
        return ranking.search_body(self.body, queries, self.n_docs, k, self.titles, self.stopwords)

    def search_title(self, queries: DataFrame, k: int = ranking.TOP_K) -> DataFrame:
        return ranking.search_title(self.title, queries, k, self.titles, self.stopwords)

    def search_anchor(self, queries: DataFrame, k: int = ranking.TOP_K) -> DataFrame:
        return ranking.search_anchor(self.anchor, queries, k, self.titles, self.stopwords)

    def search_bm25(self, queries: DataFrame, k1: float = ranking.K1, b: float = ranking.B,
                    k: int | None = ranking.TOP_K) -> DataFrame:
        return ranking.search_bm25(self.body, queries, k1, b, k=k, titles=self.titles, stopwords=self.stopwords)

    def lookup_pagerank(self, ids: DataFrame) -> DataFrame:
        return signals.lookup_pagerank(ids, self.pagerank)

    def lookup_pageviews(self, ids: DataFrame) -> DataFrame:
        return signals.lookup_pageviews(ids, self.pageviews)

    def evaluate(self, queries: DataFrame, qrels: DataFrame, k: int = ranking.TOP_K) -> tuple[DataFrame, float]:
        """The metrics of each query, and the seconds that searching the whole batch took."""
        began = time.perf_counter()
        found = write_shared(self.search(queries, k), "run")
        seconds = time.perf_counter() - began
        return metrics.evaluate(queries, found, qrels), seconds


def ask(spark: SparkSession, *texts: str) -> DataFrame:
    """A batch from query strings, numbered from 0."""
    return spark.createDataFrame(list(enumerate(texts)), "query_id bigint, query string")


def ordered_ids(spark: SparkSession, ids: Iterable[int]) -> DataFrame:
    """``(pos, id)`` for the look-ups, from a list of ids."""
    return spark.createDataFrame(list(enumerate(ids)), "pos bigint, id bigint")


def number_of_docs(corpus: DataFrame, id_col: str = "id"):
    """Corpus size as a scalar subquery."""
    return corpus.select(id_col).distinct().agg(F.count("*")).scalar()
