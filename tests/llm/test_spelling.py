"""Words one edit apart against a plain search."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from samples import documents, no_documents, odd_texts

from trawl.llm.spelling import frequent_words, halves, near_words, common_prefix, nearest, spelling_variants, within_reach


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    n = common_prefix(a, b)
    return a[n + (len(a) == len(b)):] == b[n + 1:]


def brute(counts, ratio=2):
    by_cut = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            by_cut[i, len(w), w[:i] + w[i + 1:]].add(w)
    near = defaultdict(set)
    for own in by_cut.values():
        for w in own:
            near[w] |= own - {w}
    for w in counts:
        for cut in {w[:i] + w[i + 1:] for i in range(len(w))} & counts.keys():
            near[w].add(cut)
            near[cut].add(w)
    best = {w: min(own, key=lambda x: (-counts[x], x)) for w, own in near.items() if own}
    forms = {w: b for w, b in best.items() if counts[b] >= ratio * counts[w]}
    rows = set()
    for w, n in counts.items():
        root = w
        while root in forms:
            root = forms[root]
        rows.add((w, forms.get(w), root, n, len(near[w]), counts.get(forms.get(w))))
    return rows


def vocabulary(seed, n, signs="abcé", least=1, most=9):
    rng = random.Random(seed)
    return {"".join(rng.choice(signs) for _ in range(rng.randint(least, most))): rng.choice([3, 3, 4, 6, 9, 20, 100])
            for _ in range(n)}


def test_one_list_with_and_without_blocks():
    words = vocabulary(2, 600)
    long = {"x" * n + "y" * k: 3 + n for n in (60, 61, 62, 63, 64, 65, 130) for k in (0, 1, 2)} | {"q" + "x" * 62: 9}
    words |= long
    for turn in (lambda w: w, lambda w: w[::-1]):
        listed = sorted(map(turn, words))
        shared = [0, *map(common_prefix, listed, listed[1:])]
        for word in random.Random(1).sample(sorted(words), 80) + sorted(long):
            key, exact = halves(word)[turn("ab") == "ba"]
            found = [listed[i] for i in near_words(listed, shared, key, exact)]
            assert found == [w for w in listed if one_edit(w, key) and w[:exact] == key[:exact]]
            assert all(within_reach(key, exact, w) for w in found)
    both = Counter()
    for backwards in (False, True):
        listed = sorted(w[::-1] if backwards else w for w in words)
        counts = [words[w[::-1] if backwards else w] for w in listed]
        for word, n, _, _ in nearest(listed, counts, listed, backwards):
            both[word] += n
    assert both == {r[0]: r[4] for r in brute(words) if r[4]}


@pytest.mark.parametrize("shard_words", [4_000, 25, 4])
def test_variants(spark, shard_words):
    counts = vocabulary(7, 900) | {"hot" + w: n for w, n in vocabulary(8, 900, "abcdefgh", 0, 4).items()}
    words = spark.createDataFrame([(w, n, 1) for w, n in counts.items()], "word string, n bigint, root int")
    assert {tuple(r) for r in spelling_variants(words, shard_words=shard_words).collect()} == brute(counts)


def test_chains_ties_and_no_words(spark):
    counts = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "bbbbb": 5, "bbbbc": 5, "ccccc": 4, "ccccd": 8, "cccce": 8}
    got = {r.word: r for r in spelling_variants(
        spark.createDataFrame(list(counts.items()), "word string, n bigint")).collect()}
    assert got["aaaaa"].root == "aabbb" and got["aaaaa"].form == "aaaab" and got["aaabb"].form_n == 24
    assert got["bbbbb"].form is None and got["bbbbb"].n_near == 1 and got["ccccc"].form == "ccccd"
    assert spelling_variants(spark.createDataFrame([], "word string, n bigint")).count() == 0


def counted(rows, one_in, least_length, least_count):
    found = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.encode().lower().decode()
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % one_in == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= least_length and n >= least_count}


@pytest.mark.parametrize("one_in", [97, 2, 1])
def test_words_of_odd_documents(spark, one_in):
    rows = [*odd_texts(), (70, "É" * 70 + " éa×÷ÿþ Āb ÀÉ" + "z" * 64 + " " + "z" * 65), (71, "aé" * 40 + "1bé")]
    for length, count in ((5, 3), (1, 1)):
        found = frequent_words(documents(spark, rows), least_length=length, least_count=count, one_in=one_in)
        assert {r.word: r.n for r in found.collect()} == counted(rows, one_in, length, count)
    assert frequent_words(no_documents(spark)).count() == 0


def test_words_are_sent_on_when_many_are_held(spark, monkeypatch):
    rows = [(n, f"abcde{'xyz'[n % 3]} fghij") for n in range(50)]
    monkeypatch.setattr("trawl.llm.spelling.HELD_WORDS", 1)
    assert {r.word: r.n for r in frequent_words(documents(spark, rows)).collect()} == counted(rows, 97, 5, 3)
