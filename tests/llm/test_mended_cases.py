"""Cases that once gave wrong rows: quotes in tags, pages without names, ids that repeat with other contents."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trawl.llm import html_text, repeats, toxicity
from trawl.llm.common import UNSPACED, Words
from trawl.llm.html_blocks import leaf_blocks
from trawl.llm.near_duplicates import near_duplicates
from trawl.llm.neighbours import nearest
from trawl.llm.samples import bounded_sample


@pytest.mark.parametrize("page, texts", [
    ('<p title="a > b">x</p>', ["x"]), ('<img alt="x > y">text', ["text"]),
    ("<div data-x='{\"a\":\"<p>\"}'>t</div>", ["t"]), ("<p title = 'it>'>y", ["y"]),
    ('<a href="never closed>go</a> on <p class="x">ok</p>', ["go on", "ok"]), ('<div a="1"b="2>3">z</div>', ["z"]),
    ("<script a='>'>x>1</script>z", ["z"]), ('<p class=x>u</p><p a="b" / >v', ["u", "v"])])
def test_quotes_in_tags(page, texts):
    assert [b.text for b in leaf_blocks(page)] == texts


@pytest.mark.parametrize("unit", ['<a b="', "<a b='", "<a =", '<a "=', '<p x="y" ', '="', "<", "<a b='\"> "])
def test_broken_pages_take_linear_time(unit):
    leaf_blocks(unit * 50_000)


def test_pages_without_a_main_part_by_name(spark):
    """The names of other parts decide; columns of the result's names are replaced."""
    html = "<body><nav><a href=x>Home</a></nav><div><p>One.</p><p>Two &amp; three</p></div><div class='side footer'>Imprint</div></body>"
    pages = spark.createDataFrame([(1, "u", html, "old", 9), (2, "v", None, "old", 9)],
                                  "page_id bigint, url string, html string, text string, n_chars int")
    found = {r.page_id: r for r in html_text.extract(pages, html_text.train(pages)).collect()}
    assert (found[1].text, found[1].n_chars) == ("One.\n\nTwo & three", 17)
    assert (found[2].text, found[2].n_chars, found[2].url) == ("", 0, "v")


def test_pages_that_name_a_main_part_are_drawn(spark):
    other = [(n, f"<div><p>nothing named {n}</p></div>") for n in range(300)]
    named = [(1000 + n, f"<nav>menu {n}</nav><article><p>Text number {n}, with a comma.</p></article>") for n in range(3)]
    model = html_text.train(spark.createDataFrame(other + named, "page_id bigint, html string"), most=3)
    assert not isinstance(model, html_text.NamesOnly)


def test_neighbours_of_ids_with_several_vectors(spark):
    near = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (1, [1.0, 0.11]), (2, [1.0, 0.3]), (3, [1.0, 0.4]), (4, [1.0, 0.5]), (5, [1.0, 0.6])]
    asked = [(0, None), (0, [float("nan"), 1.0]), (0, [0.0, 0.0]), (0, [1.0, 0.0]), (0, [1.0, None])]
    clash = lambda rows: spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").select(
        "*", *[F.lit(1).alias(c) for c in ("query_id", "rank", "score")])
    found = nearest(clash(near), clash(asked), 5).orderBy("rank").collect()
    assert [(r["rank"], r.vec_id) for r in found] == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5)]
    assert found[0].score == pytest.approx(1 / (1 + 0.1 ** 2) ** 0.5)


def test_near_duplicates_of_an_id_with_several_texts(spark):
    """What is near to any text of an id is linked with the id; numbers made up for texts meet no other id."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(100)) for x in "abc")
    rows = [(7, a), (7, b), (8, a + " w"), (9, b + " w"), (11, c), (12, c + " x"), (5, c), (3, "zz yy xx"), (3, "zz yy"),
            (20, "zz yy"), (21, None), (7, b), (10, "zz yy xx"), (10, b)]
    found = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 85).collect()
    assert {r.doc_id: r.component_id for r in found} == {7: 3, 8: 3, 9: 3, 3: 3, 20: 3, 10: 3, 5: 5, 11: 5, 12: 5, 21: 21}
    assert len(found) == len(rows) and all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_pairs_are_learnt_at_the_length_of_documents():
    """Toxic where exactly one of two terms occurs, among 150 others; weights alone cannot tell more than three in four."""
    rng = np.random.default_rng(2)
    both = rng.integers(0, 2, (4000, 2))
    rows = [np.concatenate([np.flatnonzero(b), np.unique(rng.integers(2, 1000, 150))]) for b in both]
    label = (both[:, 0] ^ both[:, 1]).astype(float)
    model = toxicity.fit(rows[:3000], label[:3000], np.zeros(0, np.int64), 1000, 1.0)

    def right():
        return np.mean((toxicity.sums_of(model, rows[3000:]) * model.scale + model.shift > 0) == label[3000:])
    assert right() > 0.95
    assert 2 <= model.factors.any(1).sum() <= 64  # the other terms have none
    model.factors[:] = 0
    assert right() < 0.8


def test_telling_pairs_are_leading_eigenvectors():
    rng = np.random.default_rng(5)
    rows = [np.flatnonzero(rng.random(30) < 0.4) for _ in range(200)]
    residual = rng.normal(size=200)
    x = np.array([np.isin(np.arange(30), r) / np.sqrt(max(1, len(r))) for r in rows])
    x -= x.mean(0)
    full = (x * residual[:, None]).T @ x
    np.fill_diagonal(full, 0)
    values, vectors = np.linalg.eigh(full)
    found = toxicity.telling_pairs(toxicity.Sample(rows, 30), residual, rounds=400)
    assert np.allclose((found ** 2).sum(0)[:3], values[::-1][:3], rtol=1e-3)
    assert abs(found[:, 0] @ vectors[:, -1]) / np.linalg.norm(found[:, 0]) > 0.99


def test_sample_of_a_large_label_is_the_first_by_hash(spark):
    rows = spark.range(20_000).select(F.col("id").alias("k"), F.when(F.col("id") % 100 < 97, "a").when(
        F.col("id") % 100 < 99, "b").alias("y"))
    rows = rows.unionByName(rows.where("k < 50"))
    found = bounded_sample(rows, "k", "y", 100, 250)
    order = {r.y: [] for r in found.collect()}
    for r in found.collect():
        order[r.y].append(r.k)
    want = {}
    for r in rows.distinct().orderBy(F.xxhash64("k"), "k").collect():
        if len(want.setdefault(r.y, [])) < 100:
            want[r.y].append(r.k)
    assert {y: len(k) for y, k in order.items()} == {"a": 83, "b": 83, None: 84} or sum(map(len, order.values())) == 250
    assert all(set(order[y]) <= set(want[y]) for y in order)
    # The large label's rows were cut before they were ranked.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_bound" in plan


def line_texts(n=900):
    """A nine-word line in a third of the texts, between ever different words; and a few windows that repeat."""
    rng = random.Random(3)
    line = "this line stands in very many of the texts".split()
    again = [f"again{i}" for i in range(30)]
    rows = []
    for i in range(n):
        words = [f"w{rng.randrange(10 ** 6)}" for _ in range(60)]
        if i % 3 == 0:
            words[25:25] = line
        if i % 300 == 0:
            words[10:10] = again + line + line + line
        rows.append((i, " ".join(words)))
    return rows


def least_hashes(rows, frequent):
    words = Words([t.encode() for _, t in rows], UNSPACED)
    _, n, least = repeats.super_kmers(words, frequent=frequent)
    hashes, which = np.unique(least, return_inverse=True)
    return np.bincount(which, n, len(hashes))


def test_a_frequent_line_does_not_fill_a_bucket(spark):
    rows = line_texts()
    docs = spark.createDataFrame([(i, t) for i, t in rows], "id bigint, text string")
    frequent = repeats.frequent_pieces(docs, 100_000, 20, repeats.PIECE, windows=60, one_in=1)
    assert 0 < len(frequent) < 20
    before, after = least_hashes(rows, repeats.NOTHING), least_hashes(rows, frequent)
    assert before.max() > 100 and after.max() < 60 and after.sum() == before.sum()


@pytest.mark.parametrize("windows", [0, 60])
def test_windows_of_frequent_pieces_are_found(spark, windows):
    """With 0, every piece is frequent and each window goes by all its words."""
    rows = line_texts()
    docs = spark.createDataFrame(rows, "id bigint, text string")
    found = repeats.repeated_ranges(docs, bucket_chars=2_000, frequent_windows=windows, one_in=1)
    got = {(r.id, p) for r in found.collect() for p in range(r.start, r.stop)}
    seen, want = {}, set()
    for i, text in rows:
        words = text.split()
        for p in range(len(words) - 19):
            if seen.setdefault(tuple(words[p:p + 20]), (i, p)) != (i, p):
                want |= {(i, q) for q in range(p, p + 20)}
    assert got == want and want
