import pytest

import __spark_entry__ as entry
import check

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return check.connect(SMALL)


def test_every_query_has_sql():
    assert {f.__name__ for f in entry.REGISTERED} <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(f.__name__ for f in entry.REGISTERED))
def test_query_equals_sql(spark, db, name):
    assert check.compare(spark, db, name, SMALL).startswith("ok")


def test_entry(spark):
    found = entry.entry(spark)
    assert found.columns == ["query_id", "rank", "doc_id", "title", "score"] and found.count() > 0
