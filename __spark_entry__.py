
from __future__ import annotations

import sys
from collections.abc import Callable
from functools import wraps
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle  # noqa: E402
from trawl import fixtures as fx  # noqa: E402
from trawl.functions.text import remove_stopwords, term_frequencies, tokenize  # noqa: E402
from trawl.operators import indexing, links, metrics, ranking, signals  # noqa: E402
from trawl.plans.engine import number_of_docs  # noqa: E402
from trawl.sources import corpus as readers  # noqa: E402
from trawl.sources import store  # noqa: E402
from trawl.sources.shared import shared_path  # noqa: E402

try:
    import corpus_pipeline
    from trawl.llm import queries as llm
except ImportError as missing:  # the folder may be gone, or left without its modules
    if missing.name not in ("corpus_pipeline", "trawl.llm"):
        raise
    llm = corpus_pipeline = None

HOT_DF = oracle.HOT_DF
LOOKUP_TERMS = oracle.LOOKUP_TERMS
BLOCK_DOCS = oracle.BLOCK_DOCS
# Ids in a block that a pruned search passes over.
PRUNED_BLOCK = 64


# --- inputs -------------------------------------------------------------------------------

def _body(s, d, **cuts):
    """Index over ``documents``."""
    return indexing.build_index(fx.documents(s, d), "text", **cuts)


def _page_body(s, d):
    return indexing.build_index(fx.pages(s, d), "text")


def _title(s, d):
    return indexing.build_index(fx.pages(s, d), "title")


def _anchor(s, d):
    return indexing.build_anchor_index(fx.links(s, d))


def _pagerank(s, d, iterations=links.ITERATIONS, **kw):
    return links.pagerank(links.link_edges(fx.links(s, d)), fx.pages(s, d).select("id"),
                          iterations=iterations, **kw)


def _pageviews(s, d, on_duplicate="sum"):
    return signals.pageview_map(signals.parse_pageviews(fx.pageview_lines(s, d)), on_duplicate)


def _titles(s, d):
    return signals.title_map(fx.pages(s, d))


def _ids(s, d):
    """``(pos, id)``: the user of every event, in order, with repeats."""
    return fx.table(s, d, "events").select(F.col("event_id").alias("pos"), F.col("user_id").alias("id"))


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- text ---------------------------------------------------------------------------------

def tokenize_docs(s, d):
    tokens = fx.documents(s, d).select("id", F.posexplode(tokenize("text")).alias("pos", "token"))
    return tokens


def stopword_filter(s, d):
    tokens = fx.documents(s, d).select("id", tokenize("text").alias("tokens"))
    kept = tokens.select("id", remove_stopwords("tokens").alias("tokens"))
    return kept.select("id", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens"))


def term_counts(s, d):
    return term_frequencies(fx.documents(s, d), "id", "text")


def query_vectors(s, d):
    return ranking.query_terms(fx.queries(s, d))


# --- index --------------------------------------------------------------------------------

def document_frequency(s, d):
    return _body(s, d).term_stats.select("term", "df")


def collection_frequency(s, d):
    return _body(s, d).term_stats.select("term", "term_total")


def rare_term_cut(s, d):
    return _body(s, d, min_df=fx.MIN_DF).postings


def hot_term_cut(s, d):
    """Known terms with the number of postings that are left to them."""
    index = _body(s, d, min_df=fx.MIN_DF, max_df=HOT_DF)
    posted = index.postings.groupBy("term").agg(F.count("*").alias("n_postings"))
    return (index.term_stats.select("term", "df").join(posted, "term", "left")
            .select("term", "df", F.coalesce("n_postings", F.lit(0)).alias("n_postings")))


def title_index(s, d):
    return _title(s, d).postings


def anchor_index(s, d):
    return _anchor(s, d).postings


def posting_lookup(s, d):
    return indexing.posting_lists(_body(s, d), LOOKUP_TERMS)


def posting_scan(s, d):
    blocks = indexing.posting_blocks(_body(s, d), BLOCK_DOCS)
    listed = F.array_join(F.transform("postings", lambda p: F.concat_ws(":", p["doc_id"], p["tf"])), " ")
    return blocks.select("term", "block", F.size("postings").alias("n_postings"), listed.alias("postings"))


def posting_scan_ordered(s, d):
    """All postings of the title index in term and document order, with the place of each in the order."""
    scan = indexing.scan_postings(_title(s, d)).withColumn("_at", F.monotonically_increasing_id())
    place = F.row_number().over(Window.partitionBy("term").orderBy("_at"))
    return scan.select("term", "doc_id", "tf", place.alias("place"))


def index_add_docs(s, d):
    index = _body(s, d)
    return indexing.add_docs(index, fx.tokenised_benchmark(s, d)).term_stats


# --- graph --------------------------------------------------------------------------------

def corpus_links(s, d):
    """Nested links, written as Parquet and read back by glob."""
    path = shared_path(s, "corpus")
    fx.nested_corpus(s, d).write.parquet(path)
    return links.links_of(readers.read_corpus(s, f"{path}/*.parquet"))


def link_edges(s, d):
    return links.link_edges(fx.links(s, d))


def link_vertices(s, d):
    return links.link_vertices(fx.pages(s, d))


def pagerank_3(s, d):
    return _rounded(_pagerank(s, d, 3), "pagerank")


def pagerank_10(s, d):
    return _rounded(_pagerank(s, d), "pagerank")


def pagerank_out_of_corpus(s, d):
    """Links to pages outside the corpus take part, their targets are not returned."""
    found, docs = fx.links_out_of_corpus(s, d)
    return _rounded(links.pagerank(links.link_edges(found), docs), "pagerank")


# --- signals ------------------------------------------------------------------------------

def pageviews_read(s, d):
    """Lines written as bz2 text, read back and parsed."""
    path = shared_path(s, "pageviews")
    fx.pageview_lines(s, d).write.option("compression", "bzip2").text(path)
    return signals.parse_pageviews(readers.read_pageviews(s, path))


def pageviews_parse(s, d):
    return signals.parse_pageviews(fx.pageview_lines(s, d))


def pageviews_map(s, d):
    return _pageviews(s, d)


def pageviews_map_max(s, d):
    return _pageviews(s, d, "max")


def pageviews_map_last(s, d):
    """Of an id's lines in a log of several files the last counts."""
    path = shared_path(s, "pageviews")
    lines = fx.pageview_lines(s, d, "event_id")
    (lines.repartitionByRange(4, "event_id").sortWithinPartitions("event_id").select("value")
     .write.option("compression", "bzip2").text(path))
    return signals.pageview_map(signals.parse_pageviews(readers.read_pageviews(s, path, positions=True)), "last")


def title_map(s, d):
    return _titles(s, d)


def title_map_repeated(s, d):
    """One title for each id of many."""
    return signals.title_map(fx.repeated_titles(s, d))


def signal_max(s, d):
    return signals.signal_max(_pageviews(s, d), "views")


def pagerank_lookup(s, d):
    return _rounded(signals.lookup_pagerank(_ids(s, d), _pagerank(s, d, 3)), "pagerank")


def pageview_lookup(s, d):
    ids = fx.pages(s, d).select(F.col("id").alias("pos"), "id")
    return signals.lookup_pageviews(ids, _pageviews(s, d))


# --- rank ---------------------------------------------------------------------------------

def search_body(s, d):
    docs = fx.documents(s, d)
    found = ranking.search_body(_body(s, d), fx.queries(s, d), number_of_docs(docs))
    return _rounded(found, "score").drop("title")


def search_title(s, d):
    return ranking.search_title(_title(s, d), fx.queries(s, d), titles=_titles(s, d))


def search_anchor(s, d):
    return ranking.search_anchor(_anchor(s, d), fx.queries(s, d), titles=_titles(s, d))


def search_combined(s, d):
    found = ranking.search(
        _page_body(s, d), _title(s, d), _anchor(s, d), fx.queries(s, d), number_of_docs(fx.pages(s, d)),
        _pagerank(s, d), _pageviews(s, d), _titles(s, d))
    return _rounded(found, "score")


def search_combined_no_signals(s, d):
    found = ranking.search(
        _page_body(s, d), _title(s, d), _anchor(s, d), fx.queries(s, d), number_of_docs(fx.pages(s, d)))
    return _rounded(found, "score").drop("title")


def search_combined_large_batch(s, d):
    """The combined ranker by shuffle, as for a batch that is too large to broadcast."""
    found = ranking.search(
        _page_body(s, d), _title(s, d), _anchor(s, d), fx.queries(s, d), number_of_docs(fx.pages(s, d)),
        _pagerank(s, d), _pageviews(s, d), _titles(s, d), broadcast_bytes=0)
    return _rounded(found, "score")


def empty_queries(s, d):
    """Body search with queries that have no terms, only stopwords, or an unknown term."""
    docs = fx.documents(s, d)
    found = ranking.search_body(_body(s, d), fx.odd_queries(s, d), number_of_docs(docs))
    return _rounded(found, "score").drop("title")


def search_bm25(s, d):
    found = ranking.search_bm25(_body(s, d), fx.queries(s, d))
    return _rounded(found, "score").drop("title")


def search_bm25_pruned(s, d):
    """The ten best by BM25 over a saved index, passing over blocks of documents that cannot be among them."""
    path = shared_path(s, "index")
    store.save_index(_body(s, d), path, n_buckets=8, block_docs=PRUNED_BLOCK)
    found = ranking.search_bm25(store.load_index(s, path), fx.queries(s, d), k=10)
    return _rounded(found, "score").drop("title")


def search_bm25_lengths(s, d):
    """BM25 in which long documents count less, over a saved index with lengths and block bounds."""
    path = shared_path(s, "index")
    store.save_index(_body(s, d), path, n_buckets=8, block_docs=PRUNED_BLOCK, lengths=True)
    found = ranking.search_bm25(store.load_index(s, path), fx.queries(s, d), k=20, lengths=True)
    return _rounded(found, "score").drop("title")


def search_body_by_term(s, d):
    """Body search by shuffle over postings that were saved bucketed by term and are not moved for the join."""
    path = shared_path(s, "index")
    store.save_index(_body(s, d), path, n_buckets=8, by_term=True)
    found = ranking.search_body(store.load_index(s, path), fx.queries(s, d), number_of_docs(fx.documents(s, d)),
                                broadcast_bytes=0)
    return _rounded(found, "score").drop("title")


def title_resolve(s, d):
    """Documents as results: those whose id is a page's get its title."""
    results = fx.documents(s, d).select(
        F.lit(0).alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("doc_id"), F.lit(0.0).alias("score"))
    return ranking.resolve_titles(results, _titles(s, d)).select("doc_id", "title")


# --- evaluation ---------------------------------------------------------------------------

def _run(s, d):
    docs = fx.documents(s, d)
    return fx.queries(s, d), ranking.search_body(_body(s, d), fx.queries(s, d), number_of_docs(docs)), fx.qrels(s, d)


def precision_at_5(s, d):
    return metrics.precision_at_k(*_run(s, d), 5)


def recall_at_30(s, d):
    return metrics.recall_at_k(*_run(s, d), 30)


def f1_at_30(s, d):
    return metrics.f1_at_k(*_run(s, d), 30)


def average_precision_40(s, d):
    return metrics.average_precision(*_run(s, d), 40)


def results_quality(s, d):
    return metrics.results_quality(*_run(s, d))


def evaluate(s, d):
    return metrics.evaluate(*_run(s, d))


# --- round trips --------------------------------------------------------------------------

def index_save_load(s, d):
    """The body index saved, loaded under its second name and searched."""
    path = shared_path(s, "index")
    store.save_index(_body(s, d), path, n_buckets=8)
    index = store.load_index(s, f"{path}/absent", fallback=path)
    found = ranking.search_body(index, fx.queries(s, d), number_of_docs(fx.documents(s, d)))
    return _rounded(found, "score").drop("title")


def _extended(s, d):
    """The folder of a saved index to which further documents were added as a segment."""
    path = shared_path(s, "index")
    store.save_index(_body(s, d), path, n_buckets=8)
    store.append_segment(indexing.index_of_tokens(fx.tokenised_benchmark(s, d)), path)
    return path


def index_segments(s, d):
    """Statistics over a saved index and a segment added to it."""
    return store.load_index(s, _extended(s, d)).term_stats


def index_compacted(s, d):
    """All postings of an index written anew from its segments."""
    return store.compact_index(s, _extended(s, d), shared_path(s, "index")).postings


def signals_save_load(s, d):
    path = shared_path(s, "signals")
    store.save_signals(path, _pagerank(s, d, 3), _pageviews(s, d), _titles(s, d))
    ranks, views, titles = (store.load_signal(s, path, n) for n in ("pagerank", "pageviews", "titles"))
    return _rounded(titles.join(ranks, "id", "left").join(views, "id", "left"), "pagerank")


def _judged(s, d):
    """``(query, ids)``, the ids as strings."""
    return (fx.qrels(s, d).join(fx.queries(s, d), "query_id").groupBy("query")
            .agg(F.sort_array(F.collect_set(F.col("doc_id").cast("string"))).alias("ids")))


def qrels_json(s, d):
    """A judgement file with an object a line."""
    path = shared_path(s, "qrels")
    _judged(s, d).select(F.to_json(F.create_map("query", "ids"))).write.text(path)
    return readers.match_qrels(readers.read_qrels(s, path), fx.queries(s, d))


def qrels_json_object(s, d):
    """Judgement files as they are published, each one object of many queries."""
    path = shared_path(s, "qrels-object")
    place = F.row_number().over(Window.partitionBy("file").orderBy("query"))
    entries = (_judged(s, d).withColumn("file", F.pmod(F.xxhash64("query"), F.lit(4)).cast("int"))
               .withColumn("place", place)
               .select("file", "place", F.concat(F.when(F.col("place") == 1, "{").otherwise(", "),
                                                F.regexp_extract(F.to_json(F.create_map("query", "ids")),
                                                                 r"(?s)^\{(.*)\}$", 1)).alias("value")))
    ends = entries.groupBy("file").agg((F.max("place") + 1).alias("place"), F.lit("}").alias("value"))
    (entries.unionByName(ends).repartitionById(4, "file").sortWithinPartitions("file", "place").select("value")
     .write.text(path))
    return readers.match_qrels(readers.read_qrels(s, path), fx.queries(s, d))


REGISTERED = [
    tokenize_docs, stopword_filter, term_counts, query_vectors,
    document_frequency, collection_frequency, rare_term_cut, hot_term_cut, title_index, anchor_index,
    posting_lookup, posting_scan, posting_scan_ordered, index_add_docs,
    corpus_links, link_edges, link_vertices, pagerank_3, pagerank_10, pagerank_out_of_corpus,
    pageviews_read, pageviews_parse, pageviews_map, pageviews_map_max, pageviews_map_last, title_map, title_map_repeated, signal_max,
    pagerank_lookup, pageview_lookup,
    search_body, search_title, search_anchor, search_combined, search_combined_no_signals,
    search_combined_large_batch, empty_queries, search_bm25, search_bm25_pruned, search_bm25_lengths,
    search_body_by_term,
    title_resolve,
    precision_at_5, recall_at_30, f1_at_30, average_precision_40, results_quality, evaluate,
    index_save_load, index_segments, index_compacted, signals_save_load, qrels_json, qrels_json_object,
]


def entry(spark: SparkSession) -> DataFrame:
    """The combined ranker over pages, 100 results per query."""
    return search_combined(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {f.__name__: f for f in REGISTERED}
    if llm is not None:
        found |= {n: _importable(f) for n, f in (llm.QUERIES | {"pipeline": corpus_pipeline.run}).items()}
    return found


def _importable(query):
    """The query with this folder on the Python workers' path, for sessions started elsewhere."""
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parent))
        return query(spark, sf_dir)
    return run


def oracle_sql() -> dict[str, str]:
    found = oracle.statements()
    if llm is not None:
        found |= llm.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL is not None:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
