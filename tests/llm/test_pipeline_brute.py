"""All rows of the pipeline against plain Python versions of its stages, the toxicity model's predictions taken as given."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from trawl.llm import toxicity
from trawl.llm.tokens import vocabulary

ITEM = "one item of the test set has these twelve words in a row"


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(["stone", "river", "house", "green", "walks", "under", "bridge", "light"]) + str(rng.randrange(90))
                    for _ in range(n))


def rows():
    """``(doc_id, text, lang, source, n_chars)``: copies, near copies, passages, secrets, insults, nulls, repeats, a long text."""
    texts = [(n, prose(n, 40)) for n in range(12)]
    texts += [(20, prose(3, 40)), (21, prose(3, 40) + " more"), (22, prose(4, 40).upper()), (23, prose(5, 39) + " other")]
    texts += [(30, f"{prose(50, 8)} {ITEM.title()} {prose(51, 8)}"), (31, f"{prose(52, 8)} {ITEM[:30]} {prose(53, 8)}")]
    texts += [(40, "call with password = hunter2secret now"), (41, "token:abcdefg and api_key='Zx81Qq'")]
    texts += [(50 + n, f"you awful martian {prose(80 + n, 12)}") for n in range(20)]
    texts += [(80, None), (81, ""), (82, " \n "), (83, "two words"), (83, "two words"), (None, prose(60, 20)), (None, None)]
    texts += [(90, ". ".join(prose(300 + n, 30) for n in range(200)))]
    return [(i, t, None if i == 5 else "en", "s", None if t is None else len(t)) for i, t in texts]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows(), "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(
        f"{path}/documents.parquet")
    labels = [(i, 1, int(50 <= i < 80)) for i, *_ in rows() if i is not None and i not in (80, 81)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def without_near_copies(docs):
    """Five words, 80 per cent; groups are closed under links, and of each the least id stays."""
    sets = {}
    for n, (i, text) in enumerate(docs):
        words = [w for w in re.split(r"[ \t-\r]+", (text or "").encode().lower().decode()) if w]
        sets[n] = {tuple(words[p:p + 5]) for p in range(max(1, len(words) - 4))} if words else set()
    group = {n: n for n in sets}

    def top(n):
        while group[n] != n:
            n = group[n]
        return n
    for a in sets:
        for b in range(a):
            same = docs[a][0] is not None and docs[a][0] == docs[b][0]
            alike = sets[a] and sets[b] and None not in (docs[a][0], docs[b][0]) and (
                100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
            if same or alike:
                group[top(a)] = top(b)
    least = defaultdict(list)
    for n in sets:
        least[top(n)].append(docs[n][0])
    return [d for n, d in enumerate(docs) if d[0] is None or d[0] == min(i for i in least[top(n)])]


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower().decode())


def clean(docs):
    item = words_of(ITEM)
    windows = {tuple(item[p:p + 10]) for p in range(len(item) - 9)}
    return [(i, t) for i, t in docs if not any(tuple(words_of(t)[p:p + 10]) in windows for p in range(len(words_of(t))))]


def redacted(docs):
    secret = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    cut = lambda m: "[assign]" if len(m[2]) >= 6 else m[0]
    return [(i, t if t is None else secret.sub(cut, t)) for i, t in docs]


def test_run_equals_plain_python(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.train_on_folds(table, spark.read.parquet(f"{folder}/labels.parquet"))
    docs = [(r.doc_id, r.text) for r in toxicity.score(table, model).where("predicted = 0").collect()]
    assert len(docs) < len(rows())
    docs = redacted(clean(without_near_copies(docs)))
    ids = {i for i, _ in docs}
    assert {20, 21, 22, 23, 30} & ids == set() and {0, 3, 31, 40, 41, 80, 81, 83, 90, None} <= ids
    assert dict(docs)[40] == "call with [assign] now"

    library = Tokenizer.from_file(vocabulary())
    encoded = [(i, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in docs]
    pieces = pipeline.run(spark, folder).collect()
    # Each document's pieces in order are its ids; rows of one id are told apart by their lengths and contents.
    want = sorted((str(i), len(own)) for i, own in encoded)
    assert sorted((str(p.doc_id), p.doc_tokens) for p in pieces if p.start == 0) == want
    for p in pieces:
        assert any(str(i) == str(p.doc_id) and len(own) == p.doc_tokens and p.ids_crc32 == zlib.crc32(
            np.array(own[p.start:p.start + p.length], "<u4").tobytes()) for i, own in encoded)
    assert sum(p.length for p in pieces) == sum(len(own) for _, own in encoded)
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    for own in sequences.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(own), sorted(own)[1:])) and min(own)[0] == 0
        assert sum(n for _, n in own) <= 4096


@pytest.mark.parametrize("name", [n for n, _ in pipeline.STAGES])
def test_stages_of_empty_and_clashing_tables(spark, folder, name):
    """No rows give no rows; columns with names that the stages use themselves stay as they are."""
    stage, table = dict(pipeline.STAGES)[name], spark.read.parquet(f"{folder}/documents.parquet")
    assert stage(spark, table.limit(0), folder).count() == 0
    clash = table.selectExpr("*", "1 AS score", "2 AS predicted", "3 AS id", "4 AS kept", "5 AS spans", "6 AS crc").where(
        "doc_id IS NULL OR doc_id < 50")
    found = stage(spark, clash, folder)
    if name != "packing":
        assert found.columns == clash.columns
        assert {tuple(r) for r in found.select("score", "predicted", "id", "kept", "spans", "crc").collect()} == {(1, 2, 3, 4, 5, 6)}
    else:
        assert {r.doc_id for r in found.collect()} == {r.doc_id for r in clash.collect()}
