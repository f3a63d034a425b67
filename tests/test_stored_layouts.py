"""Saved indices with block bounds, with postings bucketed by term, and with segments."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

import brute
from test_ranking import ASKED, SCHEMA, check, cosines, lists, make_corpus
from trawl.operators import joins, ranking
from trawl.operators.indexing import build_index, index_of_tokens, posting_lists
from trawl.sources import store


def table(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def rows():
    return make_corpus()


@pytest.fixture(scope="module")
def corpus(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def asked(spark):
    return spark.createDataFrame([*enumerate(ASKED), (len(ASKED), None)], "query_id bigint, query string")


def files(path):
    return {os.path.join(folder, f): os.path.getmtime(os.path.join(folder, f))
            for folder, _, names in os.walk(path) for f in names}


# --- block bounds ---------------------------------------------------------------------------

def clustered(n=400, seed=4):
    """Documents of which a few neighbours hold the asked words very often."""
    rng = random.Random(seed)
    texts = []
    for i in range(n):
        words = rng.choices([f"word{j}" for j in range(30)], k=25)
        texts.append((i - 50, " ".join(words + ["stone"] * (rng.randint(5, 30) if 200 <= i < 230 else i % 2)
                                       + ["henge"] * (rng.randint(3, 9) if 210 <= i < 215 else 0))))
    return texts


@pytest.fixture(scope="module")
def blocked(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("blocked") / "i")
    docs = spark.createDataFrame(clustered(), "id bigint, text string")
    store.save_index(build_index(docs, "text"), path, n_buckets=4, block_docs=16)
    return store.load_index(spark, path)


def test_saved_blocks_hold_the_largest_counts(blocked):
    want = {}
    for r in blocked.postings.collect():
        n, top = want.get((r.term, r.doc_id // 16), (0, 0))
        want[r.term, r.doc_id // 16] = n + 1, max(top, r.tf)
    assert {(r.term, r.block): (r.n, r.top_tf) for r in blocked.blocks.collect()} == want


@pytest.mark.parametrize("k", [1, 20])
def test_pruned_bm25_is_the_same(spark, blocked, k):
    queries = spark.createDataFrame(list(enumerate(["stone henge", "stone", "henge word1 word1", "word3 word4 word5",
                                                    "nothingknown", "", "stone stone stone word7"])),
                                    "query_id bigint, query string")
    same = [table(ranking.search_bm25(blocked, queries, k=k, prune=p, n=n).withColumn("score", F.round("score", 9)))
            for p in (True, False) for n in (None, 20)]  # with n below df weights are negative or missing
    assert same[0] == same[2] and same[1] == same[3] and same[0]


def test_blocks_are_passed_over(spark, blocked, monkeypatch):
    queries = spark.createDataFrame([(0, "stone henge"), (1, "word3")], "query_id bigint, query string")
    made, scored = [], []
    original = ranking._Blocks.scores

    def seen(self, chosen):
        made.append(self)
        scored.append(chosen)
        return original(self, chosen)
    monkeypatch.setattr(ranking._Blocks, "scores", seen)
    found = ranking.search_bm25(blocked, queries, k=5, n=1000)
    assert found.count() == 10
    of = lambda df: df.where("query_id = 0").count()
    whole = of(made[0].bounds)
    assert whole >= 25 and sum(map(of, scored)) <= 5
    assert "doc_id, " in made[0]._ranges(scored[0])._jc.toString()


def test_bounds_too_many_to_broadcast(spark, blocked):
    queries = spark.createDataFrame([(0, "stone henge")], "query_id bigint, query string")
    few = ranking.search_bm25(blocked, queries, k=5, broadcast_bytes=5_000)
    assert table(few) == table(ranking.search_bm25(blocked, queries, k=5, prune=False))


# --- lengths of documents, terms that are not there -------------------------------------------

def by_length(corpus, query, doc, k1, b):
    """BM25 in which a document's length counts."""
    lengths = {d: sum(c.values()) for d, c in corpus.counts.items() if c}
    mean, n = sum(lengths.values()) / len(lengths), len(corpus.posted)

    def gain(term):
        tf = corpus.tf(doc, term)
        idf = math.log((n + 1) / (corpus.df[term] + 0.5))
        return idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * lengths[doc] / mean)) if tf else 0
    return math.fsum(gain(t) for t in brute.words(query) if t in corpus.posted)


@pytest.mark.parametrize("b", [0.75, 1.0])
def test_bm25_with_lengths(spark, corpus, rows, asked, tmp_path, b):
    mine = lists(rows, "text")
    want = {i: brute.scores(mine, q, lambda d, q=q: by_length(mine, q, d, 1.2, b)) for i, q in enumerate(ASKED)}
    path = str(tmp_path / "i")
    store.save_index(build_index(corpus, "text"), path, n_buckets=2, block_docs=8, lengths=True)
    saved = store.load_index(spark, path)
    assert table(saved.lengths) == table(build_index(corpus, "text").lengths)
    check(ranking.search_bm25(saved, asked, k1=1.2, b=b, k=4, lengths=True), want, k=4)
    check(ranking.search_bm25(saved, asked, k1=1.2, b=b, lengths=True, broadcast_bytes=0), want)
    check(ranking.search_bm25(build_index(corpus, "text"), asked, k1=1.2, b=b, lengths=True), want)


def test_lengths_that_were_not_saved(blocked, asked):
    with pytest.raises(ValueError):
        ranking.search_bm25(blocked, asked, lengths=True)


def test_terms_that_are_not_there_read_no_rows(spark, tmp_path):
    """Though they lie between the least and the greatest term of a row group."""
    docs = spark.range(3000).select("id", F.concat_ws(" ", F.concat(F.lit("own"), "id"), F.lit("stone")).alias("text"))
    store.save_index(build_index(docs, "text"), str(tmp_path / "i"), n_buckets=2)
    index = store.load_index(spark, str(tmp_path / "i"))

    def rows_read(df):
        df.collect()
        scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        return scan.metrics().apply("numOutputRows").value()
    for terms, some in ((["own1700x", "own99999"], False), (["own1700"], True)):
        chosen = index.restricted_to(terms)
        assert (rows_read(chosen.counted) > 0) == some and (rows_read(chosen.stored_stats) > 0) == some


# --- postings bucketed by term --------------------------------------------------------------

@pytest.fixture(params=[50_000_000, 20])
def by_term(request, spark, corpus, tmp_path):
    """The second with its more frequent terms apart."""
    path = str(tmp_path / "i")
    store.save_index(build_index(corpus, "text"), path, n_buckets=12, slice_postings=request.param, by_term=True)
    index = store.load_index(spark, path)
    assert (index.apart.count() > 0) == (request.param == 20)
    return index


@pytest.mark.parametrize("split_load", [joins.SPLIT_LOAD, 3])
def test_search_by_term(by_term, rows, asked, monkeypatch, split_load):
    monkeypatch.setattr(joins.heavy_keys, "__defaults__", (split_load,))
    monkeypatch.setattr(joins.spread_join, "__defaults__", ("inner", split_load))
    check(ranking.search_body(by_term, asked, 62, broadcast_bytes=0), cosines(lists(rows, "text")))
    assert table(by_term.postings) == table(by_term.by_term[0].unionByName(by_term.apart))


def test_bucketed_postings_are_not_moved(spark, by_term, asked):
    """Between the scan of the bucketed table and its join with the weights there is no exchange."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        batch = ranking._Batch({"body": by_term}, asked, None, 0)
        weights = batch.known_terms()
        loads = weights.groupBy("field", "term").agg(F.max("df").alias("load"))
        joined = batch._join_by_term(weights, loads)
        lines = joined._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    scan = next(n for n, line in enumerate(lines) if "Bucketed: true" in line and "SelectedBucketsCount" in line)
    join = max(n for n, line in enumerate(lines[:scan]) if "SortMergeJoin [term" in line and depth(line) < depth(lines[scan]))
    way, at = [], depth(lines[scan])
    for line in reversed(lines[join + 1:scan]):
        if depth(line) < at:
            at = depth(line)
            way.append(line)
    assert not any("Exchange" in line for line in way)


def test_large_buckets_are_written_by_several_tasks(spark, tmp_path):
    """No table of an index is dealt out by the number of buckets alone, which stays while the corpus grows."""
    rng = random.Random(3)
    texts = [(i, " ".join(rng.choices([f"word{j}" for j in range(400)], k=12))) for i in range(120)]
    docs = spark.createDataFrame(texts, "id bigint, text string")
    path, index = str(tmp_path / "i"), build_index(docs, "text")
    store.save_index(index, path, n_buckets=2, slice_postings=90, block_docs=1, by_term=True)
    for name in ("term_stats", "postings", "blocks", "by_term"):
        sizes = [r["count"] for r in spark.read.parquet(f"{path}/{name}").groupBy(F.input_file_name()).count().collect()]
        assert max(sizes) < 2 * 90 and len(sizes) >= sum(sizes) // 90, name
    loaded = store.load_index(spark, path)
    assert table(loaded.term_stats) == table(index.term_stats) and table(loaded.postings) == table(index.postings)
    assert table(loaded.by_term[0]) == table(loaded.postings) and loaded.apart.isEmpty()
    assert loaded.blocks.agg(F.sum("n")).first()[0] == loaded.postings.count() == loaded.blocks.count()
    queries = spark.createDataFrame([(0, "word1 word2 word2"), (1, "word3")], "query_id bigint, query string")
    found = [table(ranking.search_body(i, queries, 120, broadcast_bytes=most).withColumn("score", F.round("score", 9)))
             for i in (index, loaded) for most in (0, ranking.BROADCAST_BYTES)]
    assert found[0] and all(f == found[0] for f in found)


def test_index_saved_before_buckets_were_counted(spark, corpus, rows, asked, tmp_path):
    """Its info has no number of them; there are as many as the index has."""
    path = str(tmp_path / "i")
    store.save_index(build_index(corpus, "text"), path, n_buckets=3, by_term=True)
    info = spark.createDataFrame(spark.read.parquet(f"{path}/info").drop("term_buckets").collect(),
                                 spark.read.parquet(f"{path}/info").drop("term_buckets").schema)
    info.write.mode("overwrite").parquet(f"{path}/info")
    check(ranking.search_body(store.load_index(spark, path), asked, 62, broadcast_bytes=0), cosines(lists(rows, "text")))


# --- segments -------------------------------------------------------------------------------

MORE = [(200 + i, "stone " * (i + 1) + "newword everywhere") for i in range(5)]


def added(spark, path, more=MORE):
    docs = spark.createDataFrame([(i, t.split()) for i, t in more], "doc_id bigint, tokens array<string>")
    store.append_segment(index_of_tokens(docs), path)


@pytest.mark.parametrize("layout", [{}, {"block_docs": 16, "by_term": True}])
def test_segments_equal_a_fresh_build(spark, corpus, rows, asked, tmp_path, layout):
    path = str(tmp_path / "i")
    store.save_index(build_index(corpus, "text"), path, n_buckets=3, **layout)
    first, before = files(path), store.load_index(spark, path)
    added(spark, path, MORE[:2])
    added(spark, path, MORE[2:])
    assert {f: t for f, t in files(path).items() if f in first} == first
    whole = build_index(corpus.select("id", "text").union(spark.createDataFrame(MORE, "id bigint, text string")), "text")
    index = store.load_index(spark, path)
    assert before.postings.count() < index.postings.count()
    compacted = store.compact_index(spark, path, str(tmp_path / "c"))
    mine = brute.Corpus([(r[0], r[2]) for r in rows] + MORE)
    for got in (index, compacted):
        assert table(got.postings) == table(whole.postings) and table(got.term_stats) == table(whole.term_stats)
        assert table(posting_lists(got, ["stone", "newword"])) == table(posting_lists(whole, ["stone", "newword"]))
        check(ranking.search_body(got, asked, 67), cosines(mine, 67))
        check(ranking.search_body(got, asked, 67, broadcast_bytes=0), cosines(mine, 67))
        pruned, whole_scan = (table(ranking.search_bm25(got, asked, k=7, prune=p).withColumn("score", F.round("score", 9)))
                              for p in (True, False))
        assert pruned == whole_scan
    assert store.segments_of(spark, str(tmp_path / "c")) == (0, [])


def test_hot_terms_of_all_segments_together(spark, tmp_path):
    path, docs = str(tmp_path / "i"), [(i, ["stone", f"own{i}"]) for i in range(6)]
    build = lambda part, **cut: index_of_tokens(spark.createDataFrame(
        part, "doc_id bigint, tokens array<string>"), **cut)
    store.save_index(build(docs[:3], max_df=5), path, n_buckets=2)
    store.append_segment(build(docs[3:]), path)
    index, fresh = store.load_index(spark, path), build(docs, max_df=5)
    assert table(index.postings) == table(fresh.postings) and table(index.term_stats) == table(fresh.term_stats)
    compacted = store.compact_index(spark, path, str(tmp_path / "c"))
    assert table(compacted.postings) == table(fresh.postings) and table(compacted.term_stats) == table(fresh.term_stats)
    assert posting_lists(index, ["stone"]).count() == 0 and posting_lists(index, ["own4"]).count() == 1


def test_broken_off_segment_does_not_count(spark, corpus, tmp_path, monkeypatch):
    path = str(tmp_path / "i")
    store.save_index(build_index(corpus, "text"), path, n_buckets=2)
    with monkeypatch.context() as patched, pytest.raises(ZeroDivisionError):
        patched.setattr(store, "_write_manifest", lambda *a: 1 // 0)
        added(spark, path)
    assert store.segments_of(spark, path) == (0, [])
    assert table(store.load_index(spark, path).postings) == table(build_index(corpus, "text").postings)


def test_overwriting_forgets_segments_and_what_cannot_be_extended(spark, corpus, tmp_path):
    path = str(tmp_path / "i")
    with pytest.raises(FileNotFoundError):
        added(spark, path)
    store.save_index(build_index(corpus, "text"), path, n_buckets=2)
    added(spark, path)
    with pytest.raises(ValueError):
        store.append_segment(build_index(corpus, "text", max_df=5), path)
    store.save_index(build_index(corpus, "text", min_df=3), path, n_buckets=2, mode="overwrite")
    assert store.segments_of(spark, path)[1] == []
    assert table(store.load_index(spark, path).postings) == table(build_index(corpus, "text", min_df=3).postings)
    with pytest.raises(ValueError):
        added(spark, path)
