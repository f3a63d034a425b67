import bz2
import json

import pytest
from pyspark.sql import functions as F

from trawl import ask, ordered_ids
from trawl.operators import signals
from trawl.sources import corpus as readers
from trawl.sources import store

LINES = ["12 Title 30 x", "7 a b", "en.wikipedia a 5", "9 only", "", "13  40", "14 a +5", "15 a -6 z",
         "16 a 1.5", "17 a 1_000", "12 again 3", "18 a 7\t"]


def python_pairs(lines):
    pairs = []
    for line in lines:
        fields = line.split(" ")
        try:
            pairs.append((int(fields[0]), int(fields[2])))
        except (ValueError, IndexError):
            pass
    return sorted(pairs)


def test_pageviews(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    pairs = signals.parse_pageviews(lines)
    assert sorted(map(tuple, pairs.collect())) == python_pairs(LINES)
    assert dict(map(tuple, signals.pageview_map(pairs).collect()))[12] == 33
    assert dict(map(tuple, signals.pageview_map(pairs, "max").collect()))[12] == 30
    with pytest.raises(KeyError):
        signals.pageview_map(pairs, "last")


def test_pageview_log_in_bz2(spark, tmp_path):
    (tmp_path / "views.bz2").write_bytes(bz2.compress("\n".join(LINES).encode()))
    pairs = signals.parse_pageviews(readers.read_pageviews(spark, str(tmp_path / "views.bz2")))
    assert sorted(map(tuple, pairs.collect())) == python_pairs(LINES)


def test_signal_max(spark):
    views = spark.createDataFrame([(1, 4), (2, 9)], "id bigint, views bigint")
    assert signals.signal_max(views, "views").first()[0] == 9
    assert signals.signal_max(views.where("id > 5"), "views").first()[0] == 0


def test_lookups_keep_order_and_repeats(spark):
    ids = ordered_ids(spark, [5, 2, 5, 77])
    ranks = spark.createDataFrame([(2, 0.5), (5, 1.25)], "id bigint, pagerank double")
    views = spark.createDataFrame([(2, 10)], "id bigint, views bigint")
    assert [r.pagerank for r in signals.lookup_pagerank(ids, ranks).collect()] == [1.25, 0.5, 1.25, 0.0]
    assert [r.views for r in signals.lookup_pageviews(ids, views).collect()] == [0, 10, 0, 0]


def test_title_map_has_one_row_per_id(spark):
    corpus = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, None)], "id bigint, title string")
    assert sorted(map(tuple, signals.title_map(corpus).collect()), key=str) == [(1, "a"), (2, None)]


def test_judgements(spark, tmp_path):
    judged = {"stone henge": ["5", "6"], "two\nlines \"quoted\"": ["7"], "none": []}
    (tmp_path / "qrels.json").write_text(json.dumps(judged))
    queries = ask(spark, *judged)
    qrels = readers.read_qrels(spark, str(tmp_path / "qrels.json"))
    assert sorted(map(tuple, readers.match_qrels(qrels, queries).collect())) == [(0, 5), (0, 6), (1, 7)]
    (tmp_path / "lines").write_text("\n".join(json.dumps({q: [i]}) for q, ids in judged.items() for i in ids))
    lines = readers.read_qrels(spark, str(tmp_path / "lines"), one_object_per_line=True)
    assert sorted(lines.collect()) == sorted(qrels.collect())


def test_judgements_that_are_no_ids_are_dropped(spark, tmp_path):
    (tmp_path / "q").write_text(json.dumps({"a": ["5", "x7", "", "6"]}))
    assert sorted(r.doc_id for r in readers.read_qrels(spark, str(tmp_path / "q")).collect()) == [5, 6]


def test_look_up_of_a_missing_id(spark):
    ids = spark.createDataFrame([(0, None), (1, 2), (2, None)], "pos bigint, id bigint")
    ranks = spark.createDataFrame([(2, 0.5), (None, 9.0)], "id bigint, pagerank double")
    assert [r.pagerank for r in signals.lookup_pagerank(ids, ranks).collect()] == [0.0, 0.5, 0.0]


def test_signal_round_trip(spark, tmp_path):
    ranks = spark.createDataFrame([(2, 0.5)], "id bigint, pagerank double")
    store.save_signals(str(tmp_path / "s"), pagerank=ranks)
    assert store.load_signal(spark, str(tmp_path / "s"), "pagerank").collect() == ranks.collect()
    assert store.load_signal(spark, str(tmp_path / "s"), "titles") is None


def log(spark, path, parts, **options):
    """Lines in several files, in the order of ``id``."""
    lines = spark.range(3000, numPartitions=parts).select(
        F.concat_ws(" ", (F.col("id") % 7).cast("string"), F.lit("x"), F.col("id").cast("string")).alias("value"))
    lines.write.options(**options).text(path)


@pytest.mark.parametrize("options", [{}, {"compression": "bzip2"}])
def test_last_line_of_an_id_counts(spark, tmp_path, options):
    """Over files, and over splits of a file that are read by tasks of their own."""
    log(spark, str(tmp_path / "log"), 3, **options)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4000)
    try:
        pairs = signals.parse_pageviews(readers.read_pageviews(spark, str(tmp_path / "log"), positions=True))
        found = {r.id: r.views for r in signals.pageview_map(pairs, "last").collect()}
        if not options:
            assert readers.read_pageviews(spark, str(tmp_path / "log")).rdd.getNumPartitions() > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == {n % 7: n for n in range(2993, 3000)}
    with pytest.raises(ValueError):
        signals.pageview_map(pairs.drop("position"), "last")


def test_large_judgement_object_is_read_by_several_tasks(spark, tmp_path):
    judged = {f"query {i}": [str(i), str(i + 1)] for i in range(2000)}
    (tmp_path / "q.json").write_text(json.dumps(judged))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 5000)
    try:
        qrels = readers.read_qrels(spark, str(tmp_path / "q.json"))
        assert qrels.rdd.getNumPartitions() > 8
        assert sorted(map(tuple, qrels.collect())) == sorted((q, int(i)) for q, ids in judged.items() for i in ids)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


ODD_JUDGEMENTS = [
    {"a": [], "b [c] d": ["1"], "e": ["2", "12}"], "f": []}, {"with \"] a mark": ["3"], "g": ["4"]}, {}, {"n": [5, 6], "m": ["7"]},
    {"ends in \\": ["8"], "{": ["9"], "}": ["10"], ",": ["11"]}, {"x": ["a\\"], "y": ["12", "1\\\\"]}]


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("judged", ODD_JUDGEMENTS)
def test_odd_judgement_objects(spark, tmp_path, judged, indent):
    (tmp_path / "q.json").write_text(json.dumps(judged, indent=indent) + "\n")
    found = readers.read_qrels(spark, str(tmp_path / "q.json")).collect()
    assert sorted(map(tuple, found)) == sorted((q, int(i)) for q, ids in judged.items() for i in ids if str(i).isdigit())
