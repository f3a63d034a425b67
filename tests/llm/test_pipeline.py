import pytest

import __spark_entry__ as entry
import check
import corpus_pipeline as pipeline
from trawl.llm import queries
from trawl.llm.common import read

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return check.connect(SMALL)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, db, name):
    assert check.compare(spark, db, name, SMALL).startswith("ok")


def test_all_are_registered():
    assert queries.QUERIES.keys() | {"pipeline"} <= entry.queries().keys()
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name,table", [("op1_language", "documents"), ("op2_html_text", "pages"), ("op3_token_counts", "documents"),
                                        ("op7_secrets", "documents"), ("op8_toxicity", "documents")])
def test_one_row_for_each_row(spark, name, table):
    found = entry.queries()[name](spark, SMALL)
    assert found.count() == read(spark, SMALL, table).count()


def test_stages(spark):
    """Each stage returns the columns of documents, keeps what it should, and reads what the one before left."""
    docs = read(spark, SMALL, "documents")
    columns = docs.columns
    extra = spark.createDataFrame([
        (10_001, "you stupid clown", "en", "x", 1), (10_002, "contact password=abc123def now", "en", "x", 1),
        (10_003, docs.first().text, "en", "x", 1), (10_004, None, None, None, None),
        (10_005, "start " + read(spark, SMALL, "benchmark").first().text, "en", "x", 1)], docs.schema)
    docs = docs.union(extra)
    for n, (name, stage) in enumerate(pipeline.STAGES):
        left = stage(spark, docs, SMALL).cache()
        if n < len(pipeline.STAGES) - 1:
            assert left.columns == columns
            docs = left
        rows = {r.doc_id: r for r in left.collect()}
        assert 10_004 in rows
        assert (10_003 in rows) == (n < 1) and (10_005 in rows) == (n < 2)
        if name == "secrets":
            assert rows[10_002].text == "contact [assign] now" and rows[10_002].n_chars == 20
    assert left.columns[:2] == ["doc_id", "start"]


def test_run_equals_its_stages(spark):
    docs = read(spark, SMALL, "documents")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    key = lambda r: tuple(map(str, r))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    found = pipeline.run(spark, SMALL)
    assert {r.doc_id for r in found.collect()} == {r.doc_id for r in docs.collect()}
    assert sum(r.length for r in found.collect()) == sum(r.length for r in docs.collect())
    assert found.select(columns).columns == columns and sorted(map(key, found.collect()))
