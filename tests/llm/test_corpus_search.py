"""Decontamination, repeated windows, near duplicates and neighbours against brute force."""

import hashlib
import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from samples import WORDS, documents, no_documents, odd_texts, prose
from trawl.llm import decontamination as deco
from trawl.llm import near_duplicates as near
from trawl.llm import neighbours, repeats
from trawl.llm.common import UNSPACED, Words
from trawl.llm.components import components

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UNBLANK = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- words ------------------------------------------------------------------------------------

@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab é\n\t\x0b\x1c\xa0", max_size=30), max_size=5))
def test_words_as_arrays(texts):
    words = Words([t.encode() for t in texts], UNSPACED)
    found = [words.buffer[a:b].decode() for a, b in zip(words.starts, words.ends)]
    want = [(n, w) for n, t in enumerate(texts) for w in UNBLANK.findall(t)]
    assert list(zip(words.text.tolist(), found)) == want
    by_word = defaultdict(set)
    for w, h in zip(found, words.hashes.tolist()):
        by_word[w].add(h)
    assert all(len(h) == 1 for h in by_word.values()) and len(set.union(*by_word.values(), set())) == len(by_word)


# --- decontamination --------------------------------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=60), st.integers(1, 20))
def test_suffix_array(text, depth):
    text = np.array(text)
    order = deco.suffix_array(text, depth)
    keys = [tuple(text[i:i + depth]) for i in order]
    assert sorted(order.tolist()) == list(range(len(text))) and keys == sorted(keys)


def items_to_find():
    passage = prose(50, 30)
    return [("1", passage), ("2", prose(1, 40).upper()), ("3", "la la la"), ("4", ""), ("5", None), (None, prose(7, 20)),
            ("6", "x" * 5000), ("1", passage), ("7", "12345"), ("8", passage + " " + prose(51, 12)), ("10", "no such words here")]


def tainted():
    passage = prose(50, 30).split()
    return [*odd_texts(), (20, "before " + " ".join(passage[3:25]) + " after " + " ".join(passage[10:30])),
            (21, " ".join(passage[:9]) + " gap " + " ".join(passage[9:18])), (22, "la LA, la-la")]


def brute_matches(text, tests, window=10):
    w, hit, items = ALNUM.findall(lower(text)), set(), set()
    for item, t in tests:
        own = ALNUM.findall(lower(t))
        n = min(window, len(own))
        wanted = {tuple(own[i:i + n]) for i in range(len(own) - n + 1)} if own and item else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in wanted:
                hit.update(range(i, i + n))
                items.add(item)
    return len(w), len(hit), items


@pytest.mark.parametrize("block", [deco.BLOCK_BYTES, 300])
def test_contamination(spark, monkeypatch, block):
    monkeypatch.setattr(deco, "BLOCK_BYTES", block)
    tests = items_to_find()
    table = spark.createDataFrame(tests, "item_id string, text string")
    found = deco.contamination(deco.find_matches(documents(spark, tainted()), table)).collect()
    assert len(found) == len(tainted())
    for r in found:
        n, hit, items = brute_matches(r.text, tests)
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, hit, len(items), digest, hit > 0)
        assert r.bucket == 4
        for m in r.matches:  # verbatim, and not extendable on either side
            w, t = ALNUM.findall(lower(r.text)), ALNUM.findall(lower(dict(tests)[m.item_id]))
            assert w[m.start:m.start + m.length] == t[m.item_start:m.item_start + m.length]
            assert not (m.start and m.item_start and w[m.start - 1] == t[m.item_start - 1])
            end, item_end = m.start + m.length, m.item_start + m.length
            assert not (end < len(w) and item_end < len(t) and w[end] == t[item_end])
    clean = deco.decontaminate(documents(spark, tainted()), table)
    assert clean.columns == documents(spark).columns
    assert clean.count() == sum(not r.contaminated for r in found) > 0
    assert deco.find_matches(no_documents(spark), table).count() == 0
    assert deco.contamination(deco.find_matches(documents(spark), table.limit(0))).where("contaminated").count() == 0


# --- repeats ----------------------------------------------------------------------------------

def copies():
    shared, rng = prose(60, 45).split(), random.Random(1)
    rows = [(100 + n, f"{prose(200 + n, rng.randint(0, 30))} {' '.join(shared[rng.randint(0, 9):])} {prose(300 + n, 12)}")
            for n in range(25)]
    return [*odd_texts(), *rows, (90, " ".join(["tick tock"] * 40)), (8, prose(5, 30_000)[500:4000])]


def brute_removed(rows, window=20):
    first = {}
    key = lambda i: (i is None, i or 0)
    for i, t in rows:
        w = UNBLANK.findall(t or "")
        for p in range(len(w) - window + 1):
            at = (key(i), p)
            first[tuple(w[p:p + window])] = min(first.get(tuple(w[p:p + window]), at), at)
    out = []
    for i, t in rows:
        w, gone = UNBLANK.findall(t or ""), set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] < (key(i), p):
                gone.update(range(p, p + window))
        out.append((str(i), len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out)


@pytest.mark.parametrize("window,piece,chars", [(20, 5, repeats.BUCKET_CHARS), (20, 3, 1000), (6, 6, 5000), (3, 1, 50_000)])
def test_repeats(spark, window, piece, chars):
    found = repeats.remove_repeats(documents(spark, copies()).repartition(3), window, piece=piece, bucket_chars=chars)
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in found.collect()) == brute_removed(copies(), window)
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept"]


def test_repeats_of_nothing(spark):
    assert repeats.remove_repeats(no_documents(spark)).count() == 0


def test_equal_hashes_of_unequal_windows_are_told_apart():
    text, zero = b"a b\nc d\na b\n", np.zeros(3, np.uint64)
    later = repeats.later_windows(text, zero, np.array([1, 2, 3]), np.array([0, 0, 0]), np.array([0, 4, 8]), np.array([3, 7, 11]))
    assert later.tolist() == [2]


def test_equal_strings_of_a_part_travel_once():
    packer = repeats.Packer(1, 20, repeats.PIECE)
    packer.add(list(range(500)), [prose(1, 60)] * 500)
    n = repeats.super_kmers(Words([" ".join(prose(1, 60).split()).encode()], UNSPACED))[0]
    assert len(packer.strings) <= len(n)
    assert all(v[0] == 0 for v in packer.strings.values())


# --- near duplicates --------------------------------------------------------------------------

def families():
    """Groups of edited copies, one large, and chains in which only neighbours are alike."""
    rng, rows = random.Random(9), odd_texts()
    key = iter(rng.sample(range(1000, 9000), 400))
    for n, size in enumerate([2, 3, 60, 5, 4]):
        base = prose(500 + n, 90).split()
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = rng.choice(WORDS)
            rows.append((next(key), " ".join(own)))
    chain = prose(700, 150).split()
    for n in range(25):
        rows.append((next(key), " ".join(chain[n * 3:n * 3 + 60])))
    return rows


def brute_components(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = UNBLANK.findall(lower(t))
        own = frozenset(tuple(w[p:p + size]) for p in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])
        sets[i] = own
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in combinations([i for i in sets if i is not None and sets[i]], 2):
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize("size,percent,rounds", [(3, 85, near.STAR_ROUNDS), (5, 80, 0), (5, 80, 2)])
def test_near_duplicates(spark, monkeypatch, size, percent, rounds):
    monkeypatch.setattr(near, "STAR_ROUNDS", rounds)
    rows = families()
    found = near.near_duplicates(documents(spark, rows), size, percent).collect()
    want = brute_components([r for r in rows if r[0] is not None], size, percent)
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is None:
            assert (r.component_id, r.kept) == (None, True)
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], want[r.doc_id][1] == r.doc_id)


def test_near_duplicates_removed(spark):
    docs = documents(spark, families())
    left = near.without_near_duplicates(docs)
    want = brute_components([r for r in families() if r[0] is not None], 5, 80)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(
        str(i) for i, _ in families() if i is None or want[i][1] == i)
    assert near.near_duplicates(no_documents(spark)).count() == 0
    assert near.near_duplicates(documents(spark, [(2, prose(1, 30)), (1, prose(1, 30)), (3, None)])).where("kept").count() == 2


def test_tables_meet_as_often_as_promised():
    assert near.halves_needed(85) == 8 and near.halves_needed(80) == 10 and near.halves_needed(100) == 1
    for percent in (80, 85, 95):
        s, n = (percent / 100) ** near.HALF, near.halves_needed(percent)
        assert 1 - (1 - (1 - s) ** n) ** 2 <= near.MISS


@pytest.mark.parametrize("edges", [[(n, n + 1) for n in range(40)], [(0, n) for n in range(1, 30)], [(n, 99) for n in range(9)],
                                   [(5, 5)], [], [(n * 7 % 50, n * 11 % 50) for n in range(33)]])
def test_components(spark, edges):
    found = {r.id: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    group = {v: {v} for e in edges for v in e if e[0] != e[1]}
    for a, b in edges:
        if a != b:
            joined = group[a] | group[b]
            for v in joined:
                group[v] = joined
    assert found == {v: min(g) for v, g in group.items()}


# --- neighbours -------------------------------------------------------------------------------

def vectors():
    rng = np.random.default_rng(8)
    rows = [(n, rng.normal(size=6).astype("f4").tolist()) for n in range(300)]
    rows += [(n, rows[7][1]) for n in range(300, 340)] + [(n, [2 * x for x in rows[9][1]]) for n in range(340, 345)]
    rows += [(400, None), (450, []), (500, [0.0] * 6), (550, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (600, [float("nan")] * 6),
             (650, [float("inf")] + [1.0] * 5), (700, [1.0, 2.0]), (701, [2.0, 1.0]), (None, rows[3][1]), (50, rows[50][1])]
    return rows


def brute_nearest(rows, k):
    good = {i: np.array(v, float) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, a in good.items():
        if q % 50 == 0:
            scored = [(-(a @ b) / np.sqrt((a @ a) * (b @ b)), i) for i, b in good.items() if i != q and len(b) == len(a)]
            out[q] = sorted((round(s, 12), i) for s, i in scored)[:k]
    return out


@pytest.mark.parametrize("tile,k", [(4096, 5), (16, 5), (7, 1), (64, 500)])
def test_neighbours(spark, monkeypatch, tile, k):
    monkeypatch.setattr(neighbours, "TILE_ROWS", tile)
    monkeypatch.setattr(neighbours, "TILE_QUERIES", 3)
    table = spark.createDataFrame(vectors(), "vec_id bigint, embedding array<float>").repartition(4)
    found = neighbours.nearest(table, table.where("vec_id % 50 = 0"), k)
    got = defaultdict(list)
    for r in found.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(got[r.query_id]) + 1
        got[r.query_id].append((-round(r.score, 12), r.vec_id))
    assert dict(got) == brute_nearest(vectors(), k)


def test_neighbours_in_blocks_and_of_nothing(spark, monkeypatch):
    table = spark.createDataFrame(vectors(), "vec_id bigint, embedding array<float>")
    monkeypatch.setattr(neighbours, "BLOCK_BYTES", 100)
    found = neighbours.nearest(table, table.where("vec_id % 50 = 0"))
    assert found.select("query_id").distinct().count() == len(brute_nearest(vectors(), 5))
    assert neighbours.nearest(table.limit(0), table.limit(0)).count() == 0
    assert neighbours.nearest(table.where("vec_id = 0"), table.where("vec_id = 0")).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(2)
    a, b = (neighbours.Quantised(rng.normal(size=(n, 40)) * rng.choice([1e-30, 1.0, 1e30], size=(n, 1))) for n in (30, 50))
    least, most = a.bounds(slice(0, 30), b, slice(0, 50))
    exact = np.array([[a.cosine(np.array([i]), b, np.array([j]))[0] for j in range(50)] for i in range(30)])
    assert (least <= exact).all() and (exact <= most).all() and (most - least).max() < 0.1
