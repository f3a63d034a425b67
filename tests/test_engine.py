import os

import pytest
from pyspark.sql import functions as F

from test_ranking import ASKED, SCHEMA, make_corpus
from trawl import Engine, ask
from trawl.operators import links, metrics, ranking, signals
from trawl.operators.indexing import build_anchor_index, build_index
from trawl.sources import shared
from trawl.sources.corpus import read_corpus
from trawl.sources.shared import run_folder, shared_folder, shared_path


def rows(df):
    return sorted(map(tuple, df.select("query_id", "rank", "doc_id", "title", F.round("score", 9)).collect()), key=str)


def test_build_load_and_search(spark, tmp_path):
    made = spark.createDataFrame(make_corpus(), SCHEMA)
    made.write.parquet(str(tmp_path / "corpus"))
    corpus = read_corpus(spark, str(tmp_path / "corpus" / "*.parquet"))
    lines = spark.createDataFrame([(f"{i} page {i * 3}",) for i in range(0, 60, 2)], "value string")
    engine = Engine.build(corpus, str(tmp_path / "engine"), lines, min_df=3, n_buckets=4, iterations=3)
    queries = ask(spark, *ASKED)
    assert engine.n_docs == 62

    titles, found = signals.title_map(corpus), links.links_of(corpus)
    ranks = links.pagerank(links.link_edges(found), corpus.select("id"), iterations=3)
    views = signals.pageview_map(signals.parse_pageviews(lines))
    body, title = build_index(corpus, "text", min_df=3), build_index(corpus, "title")
    unsaved = ranking.search(body, title, build_anchor_index(found), queries, 62, ranks, views, titles)
    results = engine.search(queries)
    assert rows(results) == rows(unsaved) and results.count() > 100
    assert rows(engine.search_body(queries, k=7)) == rows(ranking.search_body(body, queries, 62, 7, titles))
    assert rows(engine.search_title(queries)) == rows(ranking.search_title(title, queries, titles=titles))
    assert rows(engine.search_anchor(queries)) == rows(
        ranking.search_anchor(build_anchor_index(found), queries, titles=titles))
    assert rows(engine.search_bm25(queries, k=5)) == rows(ranking.search_bm25(body, queries, k=5, titles=titles))

    qrels = spark.createDataFrame([(0, 1), (0, 2), (1, 3)], "query_id bigint, doc_id bigint")
    measured, seconds = engine.evaluate(queries, qrels)
    assert sorted(measured.collect()) == sorted(metrics.evaluate(queries, unsaved, qrels).collect()) and seconds > 0
    ids = spark.createDataFrame([(0, 1), (1, 999)], "pos bigint, id bigint")
    assert [r.pagerank for r in engine.lookup_pagerank(ids).collect()][1] == 0.0
    assert [r.views for r in engine.lookup_pageviews(ids).collect()] == [0, 0]


def test_shared_paths_follow_the_setting(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    first, second = shared_path(spark, "x"), shared_path(spark, "x")
    assert first.startswith(named.rstrip("/")) and first.startswith(run_folder(spark)) and first != second


class Elsewhere:
    """A session that names no folder."""

    def __init__(self, master):
        self.conf, self.sparkContext = {}, self
        self.master, self.applicationId = master, f"app-{master}"

    def getCheckpointDir(self):  # noqa: N802
        return None


def test_a_cluster_without_a_shared_folder_is_an_error():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            shared_folder(Elsewhere(master))
    here = Elsewhere("local[2]")
    assert shared_folder(here) == shared_folder(here)
    assert here.conf == {}


def test_nothing_is_cut_by_default(spark, tmp_path):
    corpus = spark.createDataFrame(make_corpus(n=8), SCHEMA)
    engine = Engine.build(corpus, str(tmp_path / "engine"), n_buckets=2, iterations=1)
    terms = {r.term for r in build_index(corpus, "text").counted.select("term").distinct().collect()}
    assert {r.term for r in engine.body.postings.select("term").collect()} == terms


def test_run_folder_is_cleared(spark, tmp_path, monkeypatch):
    """In a folder of its own, as other tests read theirs."""
    monkeypatch.setattr(shared, "shared_folder", lambda spark: str(tmp_path))
    assert shared.write_shared(spark.range(3), "t").count() == 3
    assert shared.clear_run_folder(spark) and not os.path.exists(shared.run_folder(spark))
    assert not shared.clear_run_folder(spark)
