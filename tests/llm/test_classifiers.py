import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from samples import documents, no_documents, odd_texts
from trawl.llm import html_text, language, toxicity
from trawl.llm.common import remainder

TONGUES = {"xx": "aba ebe ibi obo ubu bab beb".split(), "yy": "tok tek tuk kit kat tik kot".split(),
           "zz": "sés sas sus sil lus las lés".split()}


def sentences(rng, words, n):
    return " ".join(rng.choice(words) + rng.choice(words) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def tongues(spark):
    rng = random.Random(2)
    rows = [(n, sentences(rng, TONGUES[t], rng.randint(3, 40)), t) for n in range(240) for t in [rng.choice(sorted(TONGUES))]]
    return spark.createDataFrame([*rows, (900, "text without a language", None), (None, "tok", "yy")],
                                 "doc_id bigint, text string, lang string")


def test_language(spark, tongues):
    model = language.train(tongues, remainder("doc_id", 3) != 1)
    assert model.languages == sorted(TONGUES) and 0 <= model.threshold <= 1
    found = language.identify(tongues.withColumn("held_out", remainder("doc_id", 3) == 1), model)
    held = [r for r in found.collect() if r.held_out and r.lang]
    assert len(held) > 50 and np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in held) and np.mean([r.accepted for r in held]) > 0.9


def test_language_of_odd_texts(spark, tongues):
    model = language.train(tongues, remainder("doc_id", 3) != 1)
    found = language.identify(documents(spark), model).collect()
    assert len(found) == len(odd_texts())
    for r in found:
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not lettered) and (r.score == 0) == (not lettered)
        assert lettered or not r.accepted
    assert {r.bucket for r in found} == {4}  # other columns stay
    assert language.identify(no_documents(spark), model).count() == 0


def test_language_without_training_rows(spark, tongues):
    model = language.train(tongues.where("lang is null"), F.lit(True))
    assert {r.lang_pred for r in language.identify(tongues, model).collect()} == {"und"}


def test_training_sample_is_bounded_and_takes_every_language(tongues):
    chosen = language.bounded_sample(tongues.where("lang is not null").select("doc_id", "lang"), "doc_id", "lang", 20, 30)
    assert chosen.count() <= 30 and chosen.select("lang").distinct().count() == 3


def test_subword_sums_equal_a_plain_count():
    texts = ["Aé b", "", "!!", "zz-y"]
    model = language.LanguageModel(["a", "b"], np.random.default_rng(0).normal(size=(1 << language.BITS, 2)).astype("f4"),
                                   np.zeros(2))
    buckets, weights = language.shares(texts)
    for n, p in enumerate(model.scores(texts)):
        logits = (model.table[buckets[n]] * weights[n][:, None]).sum(0) if len(buckets[n]) else np.zeros(2)
        assert np.allclose(p, language.softmax(logits), atol=1e-5)
    assert len(buckets[1]) == len(buckets[2]) == 0


@pytest.fixture(scope="module")
def judged(spark):
    """Toxic is only an insult together with a group, which no sum of single weights can tell."""
    rng = random.Random(4)
    rows, labels = [], []
    for n in range(900):
        words = [rng.choice(TONGUES["xx"]) + rng.choice(TONGUES["yy"]) for _ in range(rng.randint(5, 60))]
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words += ["awful"] * insult + ["martians"] * group
        rng.shuffle(words)
        rows.append((n, " ".join(words)))
        labels.append((n, 1, int(insult and group)))
    return (spark.createDataFrame(rows, "doc_id bigint, text string"),
            spark.createDataFrame([*labels, (5000, 1, 1), (None, 1, 0), (3, 1, None)],
                                  "doc_id bigint, quality int, toxic int"))


def test_toxicity_learns_pairs(spark, judged):
    docs, labels = judged
    model = toxicity.train(docs, labels, remainder("doc_id", 5) != 0)
    found = toxicity.score(docs, model).join(labels.where("toxic is not null"), "doc_id")
    held = found.where(remainder("doc_id", 5) == 0).collect()
    assert len(held) > 100 and np.mean([r.predicted == r.toxic for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in held)


def test_toxicity_learns_what_only_pairs_tell():
    """Toxic where exactly one of two terms occurs, which no sum of weights gives, among random other terms."""
    rng = np.random.default_rng(1)
    both = rng.integers(0, 2, (4000, 2))
    rows = [np.concatenate([np.flatnonzero(b), np.unique(rng.integers(2, 1000, 10))]) for b in both]
    label = (both[:, 0] ^ both[:, 1]).astype(float)

    def right(model):
        z = model.raw(np.repeat(np.arange(1000), [len(r) for r in rows[3000:]]), np.concatenate(rows[3000:]), 1000)
        return np.mean((z * model.scale + model.shift > 0) == label[3000:])
    model = toxicity.fit(rows[:3000], label[:3000], np.zeros(0, np.int64), 1000, 1.0)
    assert right(model) > 0.9
    model.factors[:] = 0
    assert right(model) < 0.8


def test_toxicity_keeps_rare_terms_and_terms_that_tell_in_pairs(spark):
    """A word in six texts, all toxic, half of all being so; and two words toxic where exactly one occurs."""
    rng = random.Random(8)
    rows = []
    for n in range(1600):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rare = n in range(1, 24, 4)
        words = ["qqa"] * a + ["zzb"] * b + ["wwc"] * rare + [f"f{rng.randrange(60)}" for _ in range(4)]
        rows.append((n, " ".join(words), int(rare or a != b)))
    table = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = toxicity.train(table.select("doc_id", "text"), table.select("doc_id", "toxic"), F.lit(True))
    rare, first, second = (model.slot[toxicity.distinct_terms([w])[0][0]][0] for w in ("wwc", "qqa", "zzb"))
    assert rare >= 0 and model.weights[rare] > 0
    assert model.factors[first] @ model.factors[second] < -1
    found = toxicity.score(table, model).collect()
    assert np.mean([r.predicted == r.toxic for r in found]) > 0.95


def test_factorization_machine_equals_its_formula(judged):
    rng = np.random.default_rng(3)
    slot = np.full(1 << toxicity.BITS, -1)
    texts = ["one two three two", "", "four", "one"]
    for n, b in enumerate(np.unique(np.concatenate(toxicity.distinct_terms(texts)[0]))):
        slot[b] = n
    size = int(slot.max()) + 1
    model = toxicity.FactorizationMachine(slot, 0.3, rng.normal(size=size), rng.normal(size=(size, 4)), 2.0, -1.0)
    for text, z in zip(texts, model.logits(texts)):
        own = slot[toxicity.distinct_terms([text])[0][0]]
        pairs = sum(float(model.factors[a] @ model.factors[b]) for i, a in enumerate(own) for b in own[:i])
        assert np.isclose(z, 2.0 * (0.3 + model.weights[own].sum() + pairs) - 1.0)


@pytest.mark.parametrize("kept", ["toxic = 9", "toxic = 0", "toxic = 1"])
def test_toxicity_with_one_label_or_none(spark, judged, kept):
    docs, labels = judged
    found = toxicity.score(docs, toxicity.train(docs, labels.where(kept), F.lit(True))).collect()
    assert {r.predicted for r in found} == {int(kept == "toxic = 1")}


def test_toxicity_is_fitted_by_a_task(spark, judged, monkeypatch):
    """The driver, whose memory stays taken for all later stages of a pipeline, gets the model only."""
    monkeypatch.setattr(toxicity, "fit", None)
    model = toxicity.train(*judged, F.lit(True))
    assert len(model.weights) and np.isfinite(model.weights).all()


def test_toxicity_of_odd_texts(spark, judged):
    model = toxicity.train(*judged, F.lit(True))
    found = toxicity.score(documents(spark), model).collect()
    assert len(found) == len(odd_texts()) and all(0 <= r.score <= 1 for r in found) and {r.bucket for r in found} == {4}
    assert toxicity.score(no_documents(spark), model).count() == 0


def page(rng, n):
    words = lambda k: " ".join(rng.choice(TONGUES["xx"]) for _ in range(k))
    main = [f"{words(6)} &amp; {words(rng.randint(8, 40))}." for _ in range(rng.randint(1, 6))]
    text = "".join(f"<p>{m}" + rng.choice(["</p>", "<br>", ""]) for m in main)
    html = (f"<html><head><title>{words(3)}</title><style>p{{}}</style><script>if (a<b) x('<p>no</p>')</script></head><body>"
            f"<nav><ul><li><a href=/a>{words(1)}</a><li><a href=/b>{words(1)}</a></ul></nav><!-- {words(3)} -->"
            f"<div class=\"ad\">{words(5)}</div><article><h1>{words(4)}</h1>{text}</article><footer>&copy; {words(4)}</footer>")
    return n, f"http://x/{n}", html, "\n\n".join(" ".join(m.replace("&amp;", "&").split()) for m in main)


def test_html_text(spark):
    rng = random.Random(6)
    rows = [page(rng, n) for n in range(120)]
    odd = [(900, "u", None, ""), (901, "u", "", ""), (902, None, "<p>unclosed <b", ""), (None, "u", "&lt;&#65;&bogus; <", ""),
           (903, "u", "<" * 3000 + "a" * 3000 + "<p \"" * 500, ""), (904, "u", "<script>never ends", "")]
    pages = spark.createDataFrame([*rows, *odd, rows[0]], "page_id bigint, url string, html string, want string")
    model = html_text.train(pages)
    found = html_text.extract(pages, model).collect()
    assert len(found) == len(rows) + len(odd) + 1
    for r in found:
        assert r.n_chars == len(r.text)
        if r.want:
            assert r.text.split("\n\n", 1)[1] == r.want, r.text
    assert {r.text for r in found if r.page_id in (900, 901, 904)} == {""}
    assert html_text.extract(pages.limit(0), model).count() == 0
    assert html_text.train(pages.limit(0)).p.keys() == model.p.keys()


def test_blocks_of_a_broken_page():
    blocks = html_text.leaf_blocks("<body><div id='Main-Text x'>a <b>b<i>c</b> d<br>e&nbsp;f<ul><li>1<li>2</ul>tail<table><tr><td>x<td>y")
    assert [b.text for b in blocks] == ["a bc d e f", "1", "2", "tail", "x", "y"]
    assert blocks[0].path == ["body", "div", "id:main", "id:text", "id:x"] and blocks[2].path[-2:] == ["ul", "li"]
    assert [b.linked for b in html_text.leaf_blocks("<p>go <a>there</a> now")] == [5]


def test_gradients_of_the_network():
    rng = np.random.default_rng(1)
    model = html_text.BlockLabeller()
    model.p = {k: v.astype(float) for k, v in model.p.items()}
    x, sizes = html_text.padded([rng.normal(size=(n, html_text.DIMS)) * 0.3 for n in (5, 2, 7)])
    y = (rng.random(x.shape[:2]) < 0.5).astype(float)

    def loss():
        both = np.concatenate([model._run(x, "f")[0], html_text.backwards(model._run(html_text.backwards(x, sizes), "b")[0], sizes)], 2)
        z = both @ model.p["out"] + model.p["bias"]
        valid = np.arange(x.shape[1]) < sizes[:, None]
        return ((np.logaddexp(0, z) - y * z) * valid).sum() / valid.sum()
    for name, g in model.gradients(x, y, sizes).items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = model.p[name][at]
        sides = []
        for step in (1e-3, -1e-3):
            model.p[name][at] = old + step
            sides.append(loss())
        model.p[name][at] = old
        assert np.isclose(g[at], (sides[0] - sides[1]) / 2e-3, rtol=1e-3)
