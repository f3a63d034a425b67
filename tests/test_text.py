from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from brute import WORDS
from trawl.functions.text import (CORPUS_STOPWORDS, ENGLISH_STOPWORDS, STOPWORDS, remove_stopwords,
                                  term_frequencies, tokenize)
from trawl.operators.ranking import query_terms


def python_tokens(text):
    return [m.group() for m in WORDS.finditer(text.lower())]


def tokens_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    return [r["t"] for r in df.select("id", tokenize("text").alias("t")).orderBy("id").collect()]


def test_stopword_lists():
    assert len(ENGLISH_STOPWORDS) == len(set(ENGLISH_STOPWORDS)) == 198
    assert len(CORPUS_STOPWORDS) == len(set(CORPUS_STOPWORDS)) == 21


def test_token_edges(spark):
    texts = ["don't re-use it", "ab abc", "#tag @name", "x" * 60, "a--b c-d-e", "ΟΔΟΣ İstanbul", "日本語 ½x²",
             "under_score 12 123", ""]
    assert tokens_of(spark, texts) == [python_tokens(t) for t in texts]
    assert [len(t) for t in tokens_of(spark, ["y" * 60])[0]] == [25, 25, 10]
    assert tokens_of(spark, [None]) == [None]


def test_tokens_of_whole_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for row in docs.select("text", tokenize("text").alias("t")).collect():
        assert row["t"] == python_tokens(row["text"])


def test_stopwords_keep_repeats(spark):
    df = spark.createDataFrame([(["the", "cat", "cat", "also", "sat"],)], "t array<string>")
    assert df.select(remove_stopwords("t")).first()[0] == ["cat", "cat", "sat"]
    assert df.select(remove_stopwords("t", [])).first()[0] == ["the", "cat", "cat", "also", "sat"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab' -#é", max_size=60), min_size=1, max_size=5))
def test_counts_equal_counter(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    got = {(r.term, r.doc_id): r.tf for r in term_frequencies(df, "id", "text").collect()}
    want = {(t, i): n for i, text in enumerate(texts)
            for t, n in Counter(t for t in python_tokens(text) if t not in STOPWORDS).items()}
    assert got == want


def test_counting_exchanges_nothing(spark, capsys):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    term_frequencies(docs, "doc_id", "text").explain()
    assert "Exchange" not in capsys.readouterr().out


def test_query_terms(spark):
    queries = spark.createDataFrame([(1, "Cat cat dog"), (2, "the of"), (3, None), (4, "")],
                                    "query_id bigint, query string")
    rows = {(r.query_id, r.term): (r.q_tf, r.q_len) for r in query_terms(queries).collect()}
    assert rows == {(1, "cat"): (2, 2), (1, "dog"): (1, 2)}
