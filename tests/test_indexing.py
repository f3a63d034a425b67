import pytest
from pyspark.sql import functions as F

import brute
from test_ranking import SCHEMA, make_corpus
from trawl.operators import indexing, joins
from trawl.operators.links import links_of
from trawl.operators.ranking import search_body
from trawl.sources import store


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(make_corpus(), SCHEMA)


def stats(index):
    return {r.term: (r.df, r.term_total) for r in index.term_stats.collect()}


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_cuts(corpus):
    whole = indexing.build_index(corpus, "text", min_df=0)
    counts = {t: n for t, (n, _) in stats(whole).items()}
    cut = indexing.build_index(corpus, "text", min_df=15, max_df=30)
    assert {t for t in stats(cut)} == {t for t, n in counts.items() if n > 15}
    assert {r.term for r in cut.postings.select("term").distinct().collect()} == {
        t for t, n in counts.items() if 15 < n < 30}
    hot = indexing.build_index(corpus, "text", max_df=30)
    assert stats(hot) == stats(whole)
    assert {r.term for r in hot.postings.select("term").distinct().collect()} == {t for t, n in counts.items() if n < 30}


def test_nothing_is_cut_by_default(corpus):
    index = indexing.build_index(corpus, "text")
    assert (index.min_df, index.max_df) == (0, None)
    assert rows(index.postings) == rows(index.counted)
    assert {r.term for r in index.postings.select("term").collect()} == set(stats(index))


def moved(df):
    """Exchanges in the plan, with automatic broadcasts off."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
        return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_exchanges_of_postings(corpus):
    """None without a cut or with a hot cut only; one with a rare cut; blocks add one."""
    build = lambda **cuts: indexing.build_index(corpus, "text", **cuts)
    assert moved(build().postings) == []
    hot = moved(build(max_df=30).postings)  # of statistics, one row per term and task
    assert len(hot) == 1 and "hashpartitioning(term" in hot[0]
    assert len([m for m in moved(build(min_df=5).postings) if "_part" in m]) == 2  # both sides of the one join
    assert len(moved(indexing.posting_blocks(build()))) == 1


def test_statistics_follow_postings(corpus):
    index = indexing.build_index(corpus, "text", min_df=0)
    mine = brute.Corpus([(r.id, r.text) for r in corpus.collect()])
    assert stats(index) == {t: (n, sum(tf for _, tf in mine.postings(t))) for t, n in mine.df.items()}


def test_anchor_texts_go_to_their_target(spark):
    corpus = spark.createDataFrame([
        (1, "a", "b", [(2, "big stone"), (2, "big stone"), (9, "fire")]),
        (2, "a", "b", [(2, "stone"), (1, None)]),
        (3, "a", "b", None)], SCHEMA)
    index = indexing.build_anchor_index(links_of(corpus))
    assert rows(index.postings) == [("big", 2, 2), ("fire", 9, 1), ("stone", 2, 3)]


@pytest.mark.parametrize("split", [joins.SPLIT_LOAD, 2])
def test_cut_postings_splits_frequent_terms(monkeypatch, corpus, split):
    monkeypatch.setattr(joins.spread_join, "__defaults__", ("inner", split))
    index = indexing.build_index(corpus, "text", min_df=5)
    small = indexing.cut_postings(index.counted, index.posted_terms, small=True)
    assert rows(index.postings) == rows(small)


def test_spread_join_cut_bounds_the_split_keys(spark, monkeypatch):
    monkeypatch.setattr(joins, "MAX_SPLIT_KEYS", 4)
    left = spark.range(1000).select((F.col("id") % 20).alias("k"), "id")
    left = left.unionByName(spark.range(1000, 2000).select(F.lit(3).alias("k"), "id"))
    right = spark.range(20).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    loads = left.groupBy("k").agg(F.count("*").alias("load"))
    joined = joins.spread_join(left, right, ["k"], loads, ["id"], split_load=1)
    assert rows(joined.select("k", "id", "v")) == rows(left.join(right, "k").select("k", "id", "v"))
    assert rows(joins.spread_join(left, right.where("k < 5"), ["k"], loads, ["id"], "left_semi", 1)) == rows(
        left.where("k < 5"))


def test_posting_list_and_blocks(corpus):
    index = indexing.build_index(corpus, "text", min_df=0)
    mine = brute.Corpus([(r.id, r.text) for r in corpus.collect()])
    want = {t: mine.postings(t) for t in mine.df}
    assert [tuple(r) for r in indexing.posting_list(index, "stone").collect()] == want["stone"]
    assert indexing.posting_list(index, "nothing").count() == 0
    blocks = indexing.posting_blocks(index, block_docs=16).orderBy("term", "block").collect()
    joined = {}
    for r in blocks:
        assert len(r.postings) <= 16
        joined.setdefault(r.term, []).extend(map(tuple, r.postings))
    assert joined == want
    scan = [tuple(r) for r in indexing.scan_postings(index).collect()]
    assert scan == sorted((t, d, tf) for t, p in want.items() for d, tf in p)


def test_add_docs(spark, tmp_path):
    schema = "doc_id bigint, tokens array<string>"
    index = indexing.index_of_tokens(spark.createDataFrame([(1, ["cat", "cat", "dog"]), (2, ["cat"])], schema))
    more = spark.createDataFrame([(3, ["dog", "dog", "bird"]), (4, []), (5, None)], schema)
    grown = indexing.add_docs(index, more)
    want = {"cat": (2, 3), "dog": (2, 3), "bird": (1, 1)}
    assert stats(grown) == want
    store.save_index(index, str(tmp_path / "i"), n_buckets=3)
    stored = indexing.add_docs(store.load_index(spark, str(tmp_path / "i")), more)
    assert stats(stored) == want and rows(stored.postings) == rows(grown.postings)


def test_saved_index_with_rare_cut_is_not_extended(spark, corpus, tmp_path):
    store.save_index(indexing.build_index(corpus, "text", min_df=5), str(tmp_path / "i"), n_buckets=3)
    with pytest.raises(ValueError):
        indexing.add_docs(store.load_index(spark, str(tmp_path / "i")), corpus)


@pytest.mark.parametrize("slice_postings", [store.SLICE_POSTINGS, 10])
def test_save_and_load(spark, corpus, tmp_path, slice_postings):
    index = indexing.build_index(corpus, "text", min_df=5, max_df=40)
    path = str(tmp_path / "body")
    store.save_index(index, path, n_buckets=4, slice_postings=slice_postings)
    loaded = store.load_index(spark, path)
    assert rows(loaded.term_stats) == rows(index.term_stats)
    assert rows(loaded.postings) == rows(index.postings)
    assert rows(indexing.posting_list(loaded, "stone")) == rows(indexing.posting_list(index, "stone"))
    queries = spark.createDataFrame([(0, "stone word1 word1"), (1, "everywhere word2"), (2, "absent")],
                                    "query_id bigint, query string")
    assert rows(search_body(loaded, queries, 62)) == rows(search_body(index, queries, 62))
    files = spark.read.parquet(f"{path}/postings").select(F.input_file_name().alias("f"), "bucket").distinct()
    per_bucket = [r.n for r in files.groupBy("bucket").agg(F.count("*").alias("n")).collect()]
    assert max(per_bucket) == 1 if slice_postings > 1000 else min(per_bucket) > 1


def test_lookup_reads_one_bucket(spark, corpus, tmp_path):
    store.save_index(indexing.build_index(corpus, "text", min_df=0), str(tmp_path / "i"), n_buckets=8)
    found = indexing.posting_lists(store.load_index(spark, str(tmp_path / "i")), ["stone"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "EqualTo(term,stone)" in plan
    assert "xxhash64" not in plan


def test_broken_off_save_is_not_loaded(spark, corpus, tmp_path, monkeypatch):
    path, index = str(tmp_path / "i"), indexing.build_index(corpus, "text")
    store.save_index(index, path, n_buckets=2)
    with monkeypatch.context() as m:
        m.setattr(store, "accumulate", None)
        with pytest.raises(TypeError):
            store.save_index(index, path, n_buckets=2, mode="overwrite")
    assert store.load_index(spark, path, missing_ok=True) is None
    store.save_index(index, path, n_buckets=2, mode="overwrite")
    assert rows(store.load_index(spark, path).postings) == rows(index.postings)


def test_blocks_of_large_and_negative_ids(spark):
    top = 2 ** 60
    docs = [(d, ["cat"]) for d in (-9, -8, -1, 0, 7, 8, top - 1, top, top + 7, top + 8)]
    index = indexing.index_of_tokens(spark.createDataFrame(docs, "doc_id bigint, tokens array<string>"))
    for r in indexing.posting_blocks(index, block_docs=8).collect():
        assert {p.doc_id // 8 for p in r.postings} == {r.block}


def test_load_fallback_and_missing(spark, corpus, tmp_path):
    store.save_index(indexing.build_index(corpus, "title"), str(tmp_path / "second"), n_buckets=2)
    first, second = str(tmp_path / "first"), str(tmp_path / "second")
    assert store.load_index(spark, first, fallback=second).postings.count() > 0
    assert store.load_index(spark, first, missing_ok=True) is None
    with pytest.raises(FileNotFoundError):
        store.load_index(spark, first)
