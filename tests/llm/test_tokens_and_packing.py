import zlib

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from samples import documents, no_documents, odd_texts, prose
from trawl.llm import packing, token_counts
from trawl.llm.tokens import vocabulary, word_tokenizer

LIBRARY = Tokenizer.from_file(vocabulary())


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.text(max_size=40), st.text(alphabet="aB'.,<|>é ΣİǺ\x1c\n5_", max_size=40)), max_size=6))
def test_ids_equal_the_library(texts):
    found = word_tokenizer(vocabulary()).ids(texts)
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [ids_of(t) for t in texts]


def test_ids_with_a_full_memory(monkeypatch):
    from trawl.llm import tokens
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    made = tokens.WordTokenizer(vocabulary())
    for seed in range(3):
        text = prose(seed, 200)
        assert np.frombuffer(made.ids([text])[0], "<u4").tolist() == ids_of(text)
    assert len(made.known) <= 5


def test_counts(spark, tmp_path):
    found = token_counts.token_counts(documents(spark), str(tmp_path / "cache"), limit=100).collect()
    want = sorted((i, len((t or "").encode()), len(ids_of(t)), len(ids_of(t)) > 100) for i, t in odd_texts() if i)
    assert sorted(tuple(r) for r in found if r.doc_id is not None) == want
    assert len(found) == len(odd_texts())
    assert found[0].asDict().keys() == {"doc_id", "n_bytes", "n_tokens", "over_limit"}
    assert token_counts.token_counts(no_documents(spark), str(tmp_path / "none")).count() == 0


def test_cache_encodes_only_what_is_new(spark, tmp_path):
    path = str(tmp_path / "cache")
    stored = lambda: spark.read.parquet(path).count()
    token_counts.token_counts(documents(spark, [(1, "a b"), (2, "a  b\n"), (3, "c")]), path).collect()
    assert stored() == 2  # white space makes no difference
    again = token_counts.token_counts(documents(spark, [(4, "c"), (5, " a b"), (6, "d e f")]), path).collect()
    assert stored() == 3 and {r.doc_id: r.n_tokens for r in again} == {4: 1, 5: 2, 6: 3}
    # A count under another version of the tokenizer is not used.
    other = spark.createDataFrame([("other", zlib.compress(b""), 99)], token_counts.CACHE)
    other.write.mode("append").parquet(path)
    assert token_counts.cached(spark, path, "other").count() == 1
    assert token_counts.cached(spark, path, token_counts.tokenizer_version(vocabulary())).count() == 3


def padding(lengths, window):
    return sum(0 if n & (n - 1) == 0 else window - n for n in lengths)


def check_pieces(pieces, docs, window):
    """Every id in one piece, checksums right, sequences gapless and not too long; returns their lengths."""
    want = {}
    for i, t in docs:
        want.setdefault(i, []).append([*ids_of(t), packing.END_ID])
    seen = {}
    for p in sorted(pieces, key=lambda p: (str(p.doc_id), p.sequence_id, p.offset)):
        seen.setdefault(p.doc_id, []).append(p)
    assert seen.keys() == want.keys()
    for key, own in seen.items():
        at, rest = 0, sorted(want[key])
        for p in own:
            if p.start == 0:
                assert at == 0
                ids = next(r for r in rest if zlib.crc32(np.array(r[:p.length], "<u4").tobytes()) == p.ids_crc32
                           and len(r) == p.doc_tokens)
                rest.remove(ids)
            assert p.start == at and zlib.crc32(np.array(ids[at:at + p.length], "<u4").tobytes()) == p.ids_crc32
            at += p.length
            at = 0 if at == len(ids) else at
        assert at == 0 and not rest
    sequences = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == sequences.get(p.sequence_id, 0)
        sequences[p.sequence_id] = p.offset + p.length
    assert max(sequences.values(), default=0) <= window
    return list(sequences.values())


@pytest.mark.parametrize("window,segment", [(4096, packing.SEGMENT), (256, 2000), (16, 100)])
def test_packing_round_trip(spark, window, segment):
    pieces = packing.pack(documents(spark).coalesce(1), window=window, segment=segment).collect()
    lengths = check_pieces(pieces, odd_texts(), window)
    if window >= 256:  # where a cut costs less than the padding it saves
        assert padding(lengths, window) < 0.05 * sum(lengths)
    assert packing.pack(no_documents(spark)).count() == 0


def test_cuts_are_the_cheapest():
    rng = np.random.default_rng(1)
    for _ in range(60):
        n, window = int(rng.integers(1, 40)), int(rng.integers(4, 12))
        cost = np.full(n + 1, 3)
        cost[rng.random(n + 1) < 0.4] = 1
        cost[0] = cost[-1] = 0
        least = [0] + [10 ** 9] * n
        for j in range(1, n + 1):
            for i in range(max(0, j - window), j):
                pad = 0 if (j - i) & (j - i - 1) == 0 else window - (j - i)
                least[j] = min(least[j], least[i] + pad + int(cost[j]))
        cuts = packing.choose_cuts(list(range(n + 1)), cost.tolist(), window, 0)
        spent = sum((0 if (b - a) & (b - a - 1) == 0 else window - (b - a)) + int(cost[b]) for a, b in zip(cuts, cuts[1:]))
        assert cuts[0] == 0 and cuts[-1] == n and spent == least[n]


def test_whole_documents_stay_whole_where_it_costs_nothing(spark):
    docs = [(n, " ".join(["the"] * 127)) for n in range(64)]
    pieces = packing.pack(documents(spark, docs).coalesce(1), window=1024).collect()
    assert len(pieces) == 64 and {p.length for p in pieces} == {128}
