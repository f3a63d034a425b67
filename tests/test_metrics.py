import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from trawl.functions.scoring import round3
from trawl.operators import metrics

# Judged ids, returned ids, cut-off and value.
GOLDEN = [
    ("precision", range(10), [1, 2, 3], 2, 1.0),
    ("recall", range(10), [10, 5, 3], 2, 0.1),
    ("precision", range(10), [], 2, 0.0),
    ("precision", [], [1, 2, 3], 5, 0.0),
    ("recall", [], [10, 5, 3], 2, 1.0),
    ("recall", range(10), [], 2, 0.0),
    ("f1", [], [1, 2, 3], 5, 0.0),
    ("f1", range(10), [], 2, 0.0),
    ("f1", range(10), [0, 1, 2], 2, 0.333),
    ("f1", range(50), range(5), 30, 0.182),
    ("f1", range(50), range(10), 30, 0.333),
    ("f1", range(50), range(30), 30, 0.75),
    ("quality", range(50), range(5), None, 0.308),
    ("quality", range(50), range(10), None, 0.5),
    ("quality", range(50), range(30), None, 0.857),
    ("quality", range(50), [-1] * 5 + list(range(5, 30)), None, 0.0),
]
METRICS = {"precision": metrics.precision_at_k, "recall": metrics.recall_at_k, "f1": metrics.f1_at_k,
           "quality": metrics.results_quality}


def tables(spark, cases):
    queries = spark.createDataFrame([(i,) for i in range(len(cases))], "query_id bigint")
    run = spark.createDataFrame([(i, n + 1, d) for i, (_, found) in enumerate(cases) for n, d in enumerate(found)],
                                "query_id bigint, rank int, doc_id bigint")
    qrels = spark.createDataFrame([(i, d) for i, (judged, _) in enumerate(cases) for d in judged],
                                  "query_id bigint, doc_id bigint")
    return queries, run, qrels


@pytest.mark.parametrize("metric,k", sorted({(m, k) for m, _, _, k, _ in GOLDEN}, key=str))
def test_golden(spark, metric, k):
    mine = [c for c in GOLDEN if c[0] == metric and c[3] == k]
    found = METRICS[metric](*tables(spark, [(c[1], c[2]) for c in mine]), *([] if k is None else [k]))
    assert [r[metric] for r in found.orderBy("query_id").collect()] == [c[4] for c in mine]


def by_hand(judged, found, k=40):
    """The i-th hit at rank r counts i / r; their mean as an exact fraction, rounded."""
    ranks = [r for r, d in enumerate(found, 1) if r <= k and d in judged]
    mean = sum(Fraction(i, r) for i, r in enumerate(ranks, 1)) / max(1, len(ranks))
    return round(float(mean), 3)


def test_average_precision_divides_by_hits_found(spark):
    rng = random.Random(5)
    cases = [(rng.sample(range(100), rng.randint(0, 60)), rng.sample(range(100), rng.randint(0, 90))) for _ in range(60)]
    got = metrics.average_precision(*tables(spark, cases)).orderBy("query_id").collect()
    assert [r.average_precision for r in got] == [by_hand(*c) for c in cases]


def test_every_query_has_a_row_and_repeated_judgements_count_once(spark):
    queries, run, qrels = tables(spark, [([1, 2], [1]), ([], []), ([3], [])])
    got = metrics.evaluate(queries, run, qrels.unionByName(qrels)).orderBy("query_id").collect()
    assert [(r.precision, r.recall) for r in got] == [(1.0, 0.5), (0.0, 1.0), (0.0, 0.0)]


def test_round3_equals_python(spark):
    pairs = [(a, b) for b in range(1, 401) for a in range(b + 1)] + [(n, 16000) for n in range(0, 16000, 7)]
    df = spark.createDataFrame(pairs, "a int, b int").select((F.col("a") / F.col("b")).alias("x"))
    wrong = [(r.x, r.y) for r in df.select("x", round3(F.col("x")).alias("y")).collect() if round(r.x, 3) != r.y]
    assert not wrong
    ties = [float(Fraction(2 * n + 1, 2000)) for n in range(1000)]
    df = spark.createDataFrame([(t,) for t in ties], "x double").select("x", round3(F.col("x")).alias("y"))
    assert all(round(r.x, 3) == r.y for r in df.collect())
