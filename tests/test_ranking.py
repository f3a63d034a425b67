import math
import random

import pytest
from pyspark.sql import functions as F

import brute
from trawl.operators import joins, ranking
from trawl.operators.indexing import build_anchor_index, build_index, posting_lists
from trawl.operators.links import links_of
from trawl.sources import store

VOCABULARY = [f"word{i}" for i in range(30)] + ["stone", "henge", "fire", "london", "don't", "x" * 40]


def make_corpus(seed=7, n=60):
    """Documents with a very frequent term, odd texts and links to a hub and to nowhere."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = " ".join(rng.choices(VOCABULARY, k=rng.randint(3, 40))) + " everywhere the"
        title = " ".join(rng.choices(VOCABULARY[20:], k=rng.randint(1, 4)))
        anchors = [(rng.choice([1, i, rng.randrange(n), 999]), rng.choice([title, "stone fire", None]))
                   for _ in range(rng.randint(0, 5))]
        rows.append((i, title, text, anchors))
    return [*rows, (n, None, None, None), (n + 1, "", "", [])]


SCHEMA = "id bigint, title string, text string, anchor_text array<struct<id: bigint, text: string>>"
ASKED = ["stone henge", "word1 word1 word2 fire everywhere", "everywhere", "the of and", "", "london don't",
         "unknownterm", "unknownterm stone", "x" * 40]


@pytest.fixture(scope="module")
def rows():
    return make_corpus()


@pytest.fixture(scope="module")
def corpus(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def asked(spark):
    return spark.createDataFrame([*enumerate(ASKED), (len(ASKED), None)], "query_id bigint, query string")


def lists(rows, column, **cuts):
    if column == "anchor":
        return brute.Corpus([(d, " ".join(t or "" for x, t in links if x == d))
                             for links in [[a for r in rows for a in (r[3] or [])]] for d in {x for x, _ in links}])
    return brute.Corpus([(r[0], r[{"title": 1, "text": 2}[column]]) for r in rows], **cuts)


def cosines(corpus, n_docs=62):
    return {i: brute.scores(corpus, q, lambda d, q=q: brute.cosine(corpus, q, d, n_docs)) for i, q in enumerate(ASKED)}


def binaries(corpus):
    return {i: brute.scores(corpus, q, lambda d, q=q: brute.binary(corpus, q, d)) for i, q in enumerate(ASKED)}


def blends(body, title, anchor, ranks, views, n_docs=62):
    tops = max(ranks.values(), default=0), max(views.values(), default=0)

    def of(query, doc):
        return brute.blend(brute.cosine(body, query, doc, n_docs), brute.binary(title, query, doc),
                           brute.binary(anchor, query, doc), ranks.get(doc, 0), views.get(doc, 0),
                           max(1, len(set(brute.words(query)))), *tops)
    return {i: {d: of(q, d) for c in (body, title, anchor) for d in c.matches(q)} for i, q in enumerate(ASKED)}


def check(found, want, k=100):
    """``want`` maps a query number to scores; ranks must agree and scores nearly so."""
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.doc_id, r.score))
    for q, scores in want.items():
        mine = sorted(got.pop(q, []))
        assert [(i, d) for i, d, _ in mine] == brute.best(scores, k)
        for _, d, s in mine:
            assert math.isclose(s, scores[d], rel_tol=1e-9, abs_tol=1e-12)
    assert not got


@pytest.fixture(params=["broadcast", "split"])
def way(request, monkeypatch):
    """Arguments that force either physical way to score, the second with all but the rarest terms split."""
    if request.param == "broadcast":
        return {}
    monkeypatch.setattr(joins.spread_join, "__defaults__", ("inner", 3))
    return {"broadcast_bytes": 0}


@pytest.mark.parametrize("cuts", [{}, {"min_df": 8, "max_df": 30}])
def test_body(corpus, rows, asked, way, cuts):
    index = build_index(corpus, "text", **({"min_df": 0} | cuts))
    found = ranking.search_body(index, asked, 62, **way)
    mine = lists(rows, "text", **cuts)
    check(found, cosines(mine))


def test_body_by_shuffle_without_split(corpus, rows, asked):
    found = ranking.search_body(build_index(corpus, "text", min_df=0), asked, 62, broadcast_bytes=0)
    check(found, cosines(lists(rows, "text")))


def test_title_and_anchor(corpus, rows, asked, way):
    title, anchor = build_index(corpus, "title"), build_anchor_index(links_of(corpus))
    check(ranking.search_title(title, asked, **way),
          binaries(lists(rows, "title")))
    check(ranking.search_anchor(anchor, asked, **way),
          binaries(lists(rows, "anchor")))


def test_bm25(corpus, rows, asked, way, max_df=20):
    index = build_index(corpus, "text", min_df=0, max_df=max_df)
    mine = lists(rows, "text", max_df=max_df)
    want = {i: brute.scores(mine, q, lambda d, q=q: brute.bm25(mine, q, d)) for i, q in enumerate(ASKED)}
    check(ranking.search_bm25(index, asked, **way), want)
    unranked = ranking.search_bm25(index, asked, k=None, **way)
    assert unranked.count() == sum(map(len, want.values())) and unranked.where("rank is not null").count() == 0


def check_combined(spark, corpus, rows, asked, ranks, views, **way):
    tables = {}
    if ranks is not None:
        tables = {"pagerank": spark.createDataFrame(list(ranks.items()), "id bigint, pagerank double"),
                  "pageviews": spark.createDataFrame(list(views.items()), "id bigint, views bigint")}
    found = ranking.search(build_index(corpus, "text", min_df=0), build_index(corpus, "title"),
                           build_anchor_index(links_of(corpus)), asked, 62, **tables, k=10, **way)
    check(found, blends(lists(rows, "text"), lists(rows, "title"), lists(rows, "anchor"), ranks or {}, views or {}), k=10)


def test_combined(spark, corpus, rows, asked, way):
    ranks, views = {i: 1.5 / (i + 1) for i in range(0, 60, 2)}, {i: i * i for i in range(0, 60, 3)}
    check_combined(spark, corpus, rows, asked, ranks, views, **way)


@pytest.mark.parametrize("ranks,views", [(None, None), ({}, {1: 4}), ({1: 0.0}, {})])
def test_absent_signals_leave_their_weight_to_the_others(spark, corpus, rows, asked, ranks, views):
    check_combined(spark, corpus, rows, asked, ranks, views)


def test_no_anchor_index(corpus, rows, asked):
    assert ranking.search_anchor(None, asked).count() == 0
    found = ranking.search(build_index(corpus, "text", min_df=0), build_index(corpus, "title"), None, asked, 62)
    check(found, blends(lists(rows, "text"), lists(rows, "title"), brute.Corpus([]), {}, {}))


def test_batch_equals_single_queries(spark, corpus, asked):
    index = build_index(corpus, "text", min_df=0)
    whole = ranking.search_body(index, asked, 62, k=5)
    for i in (0, 1, 5):
        alone = ranking.search_body(index, asked.where(F.col("query_id") == i), 62, k=5)
        assert sorted(alone.collect()) == sorted(whole.where(F.col("query_id") == i).collect())


def test_norm_covers_query_terms_only(spark):
    corpus = spark.createDataFrame([(1, "stone many other words besides"), (2, "stone"), (3, "fire")],
                                   "id bigint, text string")
    found = ranking.search_body(build_index(corpus, "text", min_df=0),
                                spark.createDataFrame([(1, "stone")], "query_id bigint, query string"), 3)
    assert {r.doc_id: round(r.score, 12) for r in found.collect()} == {1: 1.0, 2: 1.0}


def test_term_in_every_document_scores_zero(spark):
    corpus = spark.createDataFrame([(i, "stone") for i in range(4)], "id bigint, text string")
    found = ranking.search_body(build_index(corpus, "text", min_df=0),
                                spark.createDataFrame([(1, "stone")], "query_id bigint, query string"), 4)
    assert [(r["rank"], r.doc_id, r.score) for r in found.orderBy("rank").collect()] == [
        (i + 1, i, 0.0) for i in range(4)]


@pytest.mark.parametrize("k", [3, 1000, 1500])
def test_top_k(spark, k):
    scores = spark.range(5000).select((F.col("id") % 2).alias("query_id"), F.col("id").alias("doc_id"),
                                      (F.pmod(F.col("id") * 7919, F.lit(97)) / 10).alias("score"))
    want = {(r.query_id, r.doc_id) for q in (0, 1) for r in scores.where(F.col("query_id") == q)
            .orderBy(F.desc("score"), "doc_id").limit(k).collect()}
    top = ranking.top_k(scores, k)
    assert {(r.query_id, r.doc_id) for r in top.collect()} == want
    assert top.groupBy("query_id").agg(F.max("rank")).where(F.col("max(rank)") != k).count() == 0


def test_titles(spark):
    results = spark.createDataFrame([(1, 1, 5, 0.5), (1, 2, 6, 0.4)],
                                    "query_id bigint, rank int, doc_id bigint, score double")
    titles = spark.createDataFrame([(5, "Five")], "id bigint, title string")
    assert [r.title for r in ranking.resolve_titles(results, titles).orderBy("rank").collect()] == ["Five", "6"]
    assert [r.title for r in ranking.resolve_titles(results, None).orderBy("rank").collect()] == ["5", "6"]


def test_plan_exchanges_postings_not_pairs(corpus, asked):
    """Scores are summed where the document's postings are; only the best of each query move on."""
    found = ranking.search_body(build_index(corpus, "text", min_df=0), asked, 62)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "hashpartitioning(query_id#" in plan
    assert not [line for line in plan.splitlines() if "hashpartitioning(query_id" in line and "doc_id" in line]


def text_scans(df):
    """Scans of the corpus text in the final plan, those behind a reused exchange not counted."""
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return final.count("text#") and sum("FileScan parquet" in line and "text:string" in line for line in final.splitlines())


def test_documents_are_tokenised_once(spark, corpus, asked, tmp_path):
    """Statistics and scores read one exchange, or a written table of counted terms; no small-input spreading here."""
    corpus.write.parquet(str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    assert text_scans(ranking.search_body(build_index(stored, "text"), asked, 62)) == 1
    # What bm25 reads is the table that was written.
    assert text_scans(ranking.search_bm25(build_index(stored, "text"), asked)) == 0
    assert text_scans(posting_lists(build_index(stored, "text"), ["stone"])) == 1
    assert text_scans(build_index(stored, "text", min_df=2).postings) == 0


@pytest.mark.parametrize("saved", [False, True])
def test_tasks_grow_with_the_pairs(spark, corpus, rows, asked, tmp_path, monkeypatch, saved):
    """Pairs of queries and documents are summed and ranked by as many tasks as they ask for, not by a fixed number."""
    monkeypatch.setattr(ranking, "TASK_PAIRS", 10)
    index = build_index(corpus, "text")
    if saved:
        store.save_index(index, str(tmp_path / "i"), n_buckets=2, by_term=True)
        index = store.load_index(spark, str(tmp_path / "i"))
    held = [set(brute.words(r[2] or "")) for r in rows]
    terms = [set(brute.words(q)) for q in ASKED]
    matches = sum(t in words for words in held for q in terms for t in q)
    n = max(8, -(-min(matches, 62 * asked.count()) // 10))
    assert n > 8
    batch = ranking._Batch({"body": index}, asked, None, ranking.BROADCAST_BYTES, 62)
    assert batch.postings.rdd.getNumPartitions() == n
    for most in (0, ranking.BROADCAST_BYTES):
        found = ranking.search_body(index, asked, 62, broadcast_bytes=most)
        plan = found._jdf.queryExecution().executedPlan().toString()
        want = n if most else max(8, -(-matches // 10))
        assert any(f", {want})" in line and "doc_id" in line for line in plan.splitlines() if "Exchange hash" in line)
        check(found, cosines(lists(rows, "text")))


def test_hot_documents_by_shuffle(spark, corpus, rows, asked, monkeypatch):
    """Signals and titles come by look-ups that split a document in many results."""
    monkeypatch.setattr(joins.spread_join, "__defaults__", ("inner", 2))
    titles = spark.createDataFrame([(i, f"T{i}") for i in range(0, 60, 2)], "id bigint, title string")
    ranks, views = {i: 1.5 / (i + 1) for i in range(0, 60, 2)}, {i: i * i for i in range(0, 60, 3)}
    check_combined(spark, corpus, rows, asked, ranks, views, broadcast_bytes=0)
    found = ranking.search_body(build_index(corpus, "text"), asked, 62, titles=titles)
    assert all(r.title == (f"T{r.doc_id}" if r.doc_id < 60 and r.doc_id % 2 == 0 else str(r.doc_id)) for r in found.collect())


def test_large_batch_tokenises_once(spark, corpus, rows, asked, tmp_path, monkeypatch):
    """The terms of the batch are written once for statistics and scores; other terms are not written."""
    written = {}
    original = ranking.write_shared

    def remembered(df, name):
        table = original(df, name)
        written[name] = table
        return table
    monkeypatch.setattr(ranking, "write_shared", remembered)
    counted = []
    monkeypatch.setattr("trawl.operators.indexing.write_shared",
                        lambda df, name: counted.append(original(df, name)) or counted[-1])
    corpus.write.parquet(str(tmp_path / "c"))
    index = build_index(spark.read.parquet(str(tmp_path / "c")), "text")
    found = ranking.search_body(index, asked, 62, broadcast_bytes=0)
    check(found, cosines(lists(rows, "text")))
    assert text_scans(found) == 0 and len(counted) == 1
    assert {r.term for r in counted[0].select("term").distinct().collect()} <= {t for q in ASKED for t in brute.words(q)}
    reads = [t._jdf.queryExecution().analyzed().toString() for n, t in written.items() if n != "query-terms"]
    assert reads and not any("text#" in plan for plan in reads)


def jobs_started(spark, action):
    """Spark jobs that building something started."""
    tracker, group = spark.sparkContext.statusTracker(), f"watched-{id(action)}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        found = action()
        return found, [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_titles_start_no_search(spark, corpus, rows, asked, tmp_path, monkeypatch):
    """Building a search with titles runs only the measure of the batch, and reading it scores once."""
    titles = spark.createDataFrame([(i, f"T{i}") for i in range(0, 60, 2)], "id bigint, title string")
    monkeypatch.setattr(ranking, "write_shared", None)
    corpus.write.parquet(str(tmp_path / "c"))
    index = build_index(spark.read.parquet(str(tmp_path / "c")), "text")
    found, jobs = jobs_started(spark, lambda: ranking.search_body(index, asked, 62, titles=titles))
    assert len(jobs) <= 2  # an aggregate of the queries, in up to two jobs
    assert text_scans(found) == 1
    assert all(r.title == (f"T{r.doc_id}" if r.doc_id < 60 and r.doc_id % 2 == 0 else str(r.doc_id)) for r in found.collect())
