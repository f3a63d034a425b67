import math
import random

import pytest

from trawl.operators import links

# Edges and ranks as GraphX static PageRank gives them.
GOLDEN_EDGES = [(1, 2), (1, 3), (2, 3), (3, 1), (4, 3), (4, 5), (4, 4)]
GOLDEN = {
    3: {1: 1.5081613613599136, 2: 1.081619941637407, 3: 1.8184687714324628,
        4: 0.2958749627851083, 5: 0.2958749627851083},
    10: {1: 1.731028948698079, 2: 0.9268885457509113, 3: 1.7932956746107516,
         4: 0.27439341547012913, 5: 0.27439341547012913},
}


def by_hand(edges, docs, rounds, reset=0.15):
    vertices = {v for e in edges for v in e} | set(docs)
    out = {v: sum(1 for s, _ in edges if s == v) for v in vertices}
    rank = dict.fromkeys(vertices, 1.0)
    for _ in range(rounds):
        received = dict.fromkeys(vertices, 0.0)
        for s, d in edges:
            received[d] += rank[s] / out[s]
        rank = {v: reset + (1 - reset) * received[v] for v in vertices}
    scale = len(vertices) / sum(rank.values())
    return {v: r * scale for v, r in rank.items() if v in set(docs)}


def run(spark, edges, docs, rounds, **options):
    edge_table = spark.createDataFrame(edges, "src bigint, dst bigint")
    doc_table = spark.createDataFrame([(d,) for d in docs], "id bigint")
    found = links.pagerank(edge_table, doc_table, iterations=rounds, **options)
    return {r.id: r.pagerank for r in found.collect()}


def close(got, want):
    assert got.keys() == want.keys()
    assert all(math.isclose(got[v], want[v], rel_tol=1e-12) for v in want)


@pytest.mark.parametrize("rounds", [3, 10])
def test_golden_graph(spark, rounds):
    close(run(spark, GOLDEN_EDGES, range(1, 6), rounds), GOLDEN[rounds])
    close(by_hand(GOLDEN_EDGES, range(1, 6), rounds), GOLDEN[rounds])


@pytest.mark.parametrize("split", [links.SPLIT_LOAD, 4])
def test_hub_source_hub_target_and_strangers(spark, monkeypatch, split):
    """A page that links everywhere, one that all link to, targets outside the corpus, lone pages."""
    monkeypatch.setattr(links, "SPLIT_LOAD", split)
    rng = random.Random(3)
    edges = {(0, i) for i in range(40)} | {(i, 1) for i in range(30)}
    edges |= {(rng.randrange(30), rng.randrange(60)) for _ in range(60)}
    docs = [*range(30), 100, 101]
    close(run(spark, sorted(edges), docs, 4, checkpoint_every=2), by_hand(edges, docs, 4))
    everything = run(spark, sorted(edges), docs, 4, all_vertices=True)
    assert math.isclose(sum(everything.values()), len(everything), rel_tol=1e-12)


def test_links_without_an_end_do_not_count(spark):
    edges = [(1, 2), (2, 1), (1, None), (None, 2)]
    assert run(spark, edges, [1, 2], 5) == {1: 1.0, 2: 1.0}
    table = spark.createDataFrame([(a, b, "t") for a, b in edges], "src bigint, dst bigint, text string")
    assert sorted(map(tuple, links.link_edges(table).collect())) == [(1, 2), (2, 1)]


def test_no_edges(spark):
    close(run(spark, [], [1, 2], 3), {1: 1.0, 2: 1.0})


def test_edges_and_vertices(spark):
    corpus = spark.createDataFrame([
        (1, [(2, "a"), (2, "b"), (1, None), (9, "c")]), (2, None), (3, []), (1, [(2, "again")])],
        "id bigint, anchor_text array<struct<id: bigint, text: string>>")
    found = links.links_of(corpus)
    assert found.count() == 5
    assert sorted(map(tuple, links.link_edges(found).collect())) == [(1, 1), (1, 2), (1, 9)]
    assert sorted(map(tuple, links.link_vertices(corpus).collect())) == [(1, 1), (2, 2), (3, 3)]


def test_updated_ranks_are_near_the_limit_and_take_fewer_rounds(spark):
    """Some links are added to a graph, a page goes and a page comes; a full run starts all ranks at 1."""
    rng = random.Random(6)
    before = {(rng.randrange(300), rng.randrange(300)) for _ in range(1200)}
    after = {e for e in before if 7 not in e} | {(300, 5), (12, 300), (3, 4)}
    table = lambda edges: spark.createDataFrame(sorted(edges), "src bigint, dst bigint")
    docs = spark.range(301).where("id <> 7")
    earlier = links.pagerank(table(before), spark.range(300), iterations=40, checkpoint_every=20)
    limit = {r.id: r.pagerank for r in links.pagerank(table(after), docs, iterations=40, checkpoint_every=20).collect()}
    started = {}
    for name, ranks in (("earlier", earlier), ("none", earlier.limit(0))):
        found, started[name] = links.update_pagerank(table(after), docs, ranks, tolerance=0.02)
        found = {r.id: r.pagerank for r in found.collect()}
        assert found.keys() == limit.keys()
        assert sum(abs(found[i] - limit[i]) for i in limit) / len(limit) < 0.04
    assert 0 < started["earlier"] < started["none"]


def test_updated_ranks_of_an_unchanged_graph_take_no_round(spark):
    edges = spark.createDataFrame([(1, 2), (2, 1), (2, 2)], "src bigint, dst bigint")
    earlier = links.pagerank(edges, spark.range(1, 3), iterations=40, checkpoint_every=20)
    repeated = earlier.unionByName(earlier).unionByName(spark.createDataFrame([(9, 5.0), (None, 1.0)], earlier.schema))
    found, rounds = links.update_pagerank(edges, spark.range(1, 3), repeated, all_vertices=True)
    assert rounds == 0 and sorted(found.collect()) == sorted(earlier.collect())
    empty, rounds = links.update_pagerank(edges.limit(0), spark.range(0), earlier)
    assert empty.count() == 0
