"""License templates against readings spelt out one by one."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F
from samples import documents, no_documents, odd_texts

from trawl.llm.common import ascii_lower
from trawl.llm.license_templates import TEMPLATES, Template
from trawl.llm.licenses import Automaton, parse, scan_licenses


def readings(parts):
    """Every way to read a template, with None for any word."""
    options = []
    for part in parts:
        if isinstance(part, str):
            options.append([[part]])
        elif isinstance(part, tuple):
            options.append([[None] * n for n in range(part[0], part[1] + 1)])
        else:
            options.append([[], *readings(part)])
    return [list(itertools.chain(*way)) for way in itertools.product(*options)]


def brute(templates, words):
    found = []
    for first, t in itertools.product(range(len(words)), templates):
        fits = [len(r) for r in readings(parse(t.markup)) if len(words) - first >= len(r)
                and all(a is None or a == b for a, b in zip(r, words[first:]))]
        if fits:
            found.append((t.name, first, max(fits)))
    return sorted(found)


SMALL = [Template("a", "x", "notice", "a b [c d] {n:0-2} e"), Template("b", "y", "notice", "a b"),
         Template("c", "x", "text", "[b] a c [d [a] b] {n:1-3} a"), Template("d", "z", "text", "c c {n:2-2}")]


def test_matches_equal_every_reading():
    rng, automaton = random.Random(5), Automaton(SMALL)
    texts = [" ".join(rng.choice("abcde") for _ in range(rng.randint(0, 30))) for _ in range(300)]
    counts, found = automaton.find(texts)
    assert counts == [len(t.split()) for t in texts]
    for text, own in zip(texts, found):
        assert sorted((m[0], m[3], m[4]) for m in own) == brute(SMALL, text.split())


def test_states_may_be_forgotten(monkeypatch):
    texts = ["a b c d x e a b", "c c a b a c d a b e a"]
    want = Automaton(SMALL).find(texts)
    monkeypatch.setattr("trawl.llm.licenses.KEPT_SETS", 0)
    automaton = Automaton(SMALL)
    assert automaton.find(texts) == automaton.find(texts) == want


@pytest.mark.parametrize("markup", ["a", "{n:0-3} a b", "[a b", "a b]", "a {n:0-1} b"])
def test_templates_that_are_refused(markup):
    with pytest.raises(ValueError):
        Automaton([Template("t", "t", "text", markup)])


@pytest.mark.parametrize("template", TEMPLATES, ids=lambda t: t.name)
def test_own_wording_is_accepted_and_a_changed_word_is_not(template):
    def words(parts, optional):
        for p in parts:
            if isinstance(p, str):
                yield p, True
            elif isinstance(p, tuple):
                yield from [("holder", False)] * p[optional]
            elif optional:
                yield from ((w, False) for w, _ in words(p, optional))
    automaton = Automaton([template])
    for optional in (0, 1):
        own = list(words(parse(template.markup), optional))
        text = [w for w, _ in own]
        assert [(m[3], m[4]) for m in automaton.find([" ".join(["so", *text, "on"])])[1][0]][0] == (1, len(text))
        last = max(n for n, (_, fixed) in enumerate(own) if fixed)
        assert automaton.find([" ".join([*text[:last], "not" + text[last], *text[last + 1:]])])[1] == [[]]


def test_odd_documents(spark):
    more = [(50, "Released under the MIT\n License."), (51, "cc-by-nc-cc-by-nc 4.0"), (52, "under the MİT license"),
            (None, "Apache License, Version 2.0"), (53, "under the " * 20_000 + "mit license"), (50, None)]
    found = scan_licenses(documents(spark, more)).collect()
    assert found[0].matches[0].asDict() == {"template": "mit-notice-1", "label": "mit", "kind": "notice", "first_word": 0,
                                            "n_words": 5, "fixed": 5}
    assert [m.first_word for m in found[1].matches if m.kind == "phrase"] == [0, 3] and found[2].matches == []
    assert {m.label for m in found[3].matches} == {"apache-2"} and found[4].n_words == 40_002
    assert found[4].matches[-1].first_word == 39_998 and found[5].n_words == 0 and found[5].matches == []
    odd = {r.doc_id: r for r in scan_licenses(documents(spark)).where("doc_id IS NOT NULL").collect()}
    assert odd[2].n_words == odd[3].n_words == odd[4].n_words == 0
    text = ascii_lower(dict(r for r in odd_texts() if r[0] is not None)[11]).decode()
    assert odd[11].n_words == len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text))
    assert scan_licenses(no_documents(spark)).count() == 0
    assert scan_licenses(documents(spark)).where(F.size("matches") > 0).count() == 0
