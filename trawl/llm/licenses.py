"""License scans: templates with optional and replaceable regions as one automaton over words."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import ALPHANUMERIC, ODD, Words, ascii_lower, mix, read, text_function
from trawl.llm.license_templates import TEMPLATES, Template

#: Any word, in an edge of the automaton; and a word that stands in no template.
ANY, OTHER = -1, 0
#: Sets of states that a worker keeps; beyond that it forgets them all and makes them anew.
KEPT_SETS = 100_000
#: Mandatory words that give a score of a half.
HALF = 4

MATCHES = "array<struct<template:string,label:string,kind:string,first_word:bigint,n_words:bigint,fixed:bigint>>"
_MATCH = pa.list_(pa.struct([("template", pa.string()), ("label", pa.string()), ("kind", pa.string()),
                             ("first_word", pa.int64()), ("n_words", pa.int64()), ("fixed", pa.int64())]))
_MARK = re.compile(r"(\[)|(\])|\{\w+:(\d+)-(\d+)\}|([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)")


def parse(markup: str) -> list:
    """Words, ``(least, most)`` of a replaceable region, and lists for optional regions."""
    stack: list[list] = [[]]
    for opens, closes, least, most, word in _MARK.findall(ascii_lower(markup).decode()):
        if opens:
            stack.append([])
        elif closes:
            if len(stack) == 1:
                raise ValueError(f"a region is closed that was not opened: {markup[:60]}")
            stack[-2].append(stack.pop())
        else:
            stack[-1].append(word or (int(least), int(most)))
    if len(stack) != 1:
        raise ValueError(f"a region is not closed: {markup[:60]}")
    return stack[0]


def fixed_words(parts: list) -> int:
    """The number of mandatory words."""
    return sum(isinstance(p, str) for p in parts)


class Automaton:
    """All templates as one automaton over words, made deterministic as far as texts ask for it.

    A template is found from its first word on, and ends where the longest reading of it ends.
    """

    def __init__(self, templates: list[Template]):
        self.templates = templates
        self.fixed = []
        self.vocabulary: dict[bytes, int] = {}
        self.edges: list[list[tuple[int, int]]] = [[]]
        self.free: list[list[int]] = [[]]
        self.ends: dict[int, int] = {}
        for number, template in enumerate(templates):
            parts = parse(template.markup)
            first = self._state()
            self.free[0].append(first)
            self.ends[self._chain(parts, first)] = number
            self.fixed.append(fixed_words(parts))
        self._forget()
        self.openings = self._openings()

    def _state(self) -> int:
        self.edges.append([])
        self.free.append([])
        return len(self.edges) - 1

    def _edge(self, state: int, symbol: int) -> int:
        after = self._state()
        self.edges[state].append((symbol, after))
        return after

    def _chain(self, parts: list, state: int) -> int:
        """States for the parts, from ``state`` on; the last one."""
        for part in parts:
            if isinstance(part, str):
                state = self._edge(state, self.vocabulary.setdefault(part.encode(), len(self.vocabulary) + 1))
            elif isinstance(part, tuple):
                leaves = []
                for n in range(part[1]):
                    if n >= part[0]:
                        leaves.append(state)
                    state = self._edge(state, ANY)
                for s in leaves:
                    self.free[s].append(state)
            else:
                after = self._chain(part, state)
                self.free[state].append(after)
                state = after
        return state

    def _closed(self, states) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in found:
                    found.add(s)
                    todo.append(s)
        return frozenset(found)

    def _forget(self) -> None:
        self.numbers: dict[frozenset[int], int] = {}
        self.sets: list[frozenset[int]] = []
        self.next: list[dict[int, int]] = []
        self.accepted: list[list[int]] = []
        self.start = self._number(self._closed([0]))

    def _number(self, states: frozenset[int]) -> int:
        if states not in self.numbers:
            self.numbers[states] = len(self.sets)
            self.sets.append(states)
            self.next.append({})
            self.accepted.append(sorted(self.ends[s] for s in states if s in self.ends))
        return self.numbers[states]

    def _step(self, at: int, symbol: int) -> int:
        """The set of states after one more word; the empty set is -1."""
        after = self._closed([t for s in self.sets[at] for label, t in self.edges[s] if label in (symbol, ANY)])
        self.next[at][symbol] = found = self._number(after) if after else -1
        return found

    def _openings(self) -> np.ndarray:
        """Hashes of the pairs of words that templates may begin with."""
        words = {n: w for w, n in self.vocabulary.items()}
        begin = self._closed([0])
        pairs = set()
        for a, t in ((a, t) for s in begin for a, t in self.edges[s]):
            then = self._closed([t])
            follow = {b for s in then for b, _ in self.edges[s]}
            if ANY in follow or a == ANY or any(s in self.ends for s in then) or any(s in self.ends for s in begin):
                raise ValueError("a template begins with two words of its own")
            pairs |= {words[a] + b" " + words[b] for b in follow}
        hashes = Words(sorted(pairs), ALPHANUMERIC).hashes
        return np.unique(opening(hashes[0::2], hashes[1::2]))

    def find(self, texts: list[str]) -> tuple[list[int], list[list[tuple]]]:
        """Of each text the number of words, and its matches by first word and template."""
        if len(self.sets) > KEPT_SETS:
            self._forget()
        words = Words([ascii_lower(t) for t in texts], ALPHANUMERIC)
        found: list[list[tuple]] = [[] for _ in texts]
        h = words.hashes
        begins = np.flatnonzero(np.isin(opening(h[:-1], h[1:]), self.openings)) if len(h) > 1 else np.zeros(0, int)
        starts, ends, buffer, symbol = words.starts, words.ends, words.buffer, self.vocabulary.get
        for begin, text in zip(begins.tolist(), words.text[begins].tolist()):
            at, i, last, first = self.start, begin, int(words.firsts[text + 1]), int(words.firsts[text])
            longest: dict[int, int] = {}
            while i < last:
                word = symbol(buffer[starts[i]:ends[i]], OTHER)
                at = self.next[at][word] if word in self.next[at] else self._step(at, word)
                if at < 0:
                    break
                i += 1
                for number in self.accepted[at]:
                    longest[number] = i
            for number, end in sorted(longest.items()):
                t = self.templates[number]
                found[text].append((t.name, t.label, t.kind, begin - first, end - begin, self.fixed[number]))
        return words.counts.tolist(), found


def opening(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * ODD + second)


_MADE: dict[tuple[Template, ...], Automaton] = {}


def automaton(templates: tuple[Template, ...]) -> Automaton:
    """One per list of templates and worker process."""
    if templates not in _MADE:
        _MADE[templates] = Automaton(list(templates))
    return _MADE[templates]


def scan_licenses(docs: DataFrame, templates: list[Template] = TEMPLATES, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``(id, n_words, matches)``: every place where a template's mandatory words stand, in order of first word.

    Words are runs of letters, digits and characters beyond ASCII, with A-Z lower-cased. A match has the template,
    its label and kind, its first word, its length in words with what was put in, and its number of mandatory words.
    Templates may overlap and repeat; of one template and first word the longest reading counts. A template begins
    with two words of its own, else it is refused.

    A row stays a row, whatever its id is, repeated or null; null and empty texts have no words and no
    matches. Whole texts are read. Other columns are ignored; an empty table gives an empty result. Work is one scan:
    a walk from a place where a template may begin is no longer than the longest template.
    """
    chosen = tuple(templates)

    def compute(texts: list[str]) -> list:
        counts, found = automaton(chosen).find(texts)
        names = [f.name for f in _MATCH.value_type]
        return [counts, [[dict(zip(names, m)) for m in own] for own in found]]

    scan = text_function(compute, f"struct<n_words:bigint,matches:{MATCHES}>", ["n_words", "matches"],
                         [pa.int64(), _MATCH])
    return (docs.select(F.col(id_col), scan(F.col(text_col)).alias("_found"))
            .select(id_col, "_found.n_words", "_found.matches"))


def op11_licenses(spark, sf_dir):
    found = scan_licenses(read(spark, sf_dir, "documents"))
    part = lambda rows, name: F.transform(rows, lambda m: m[name])
    listed = lambda rows: F.array_join(F.array_sort(F.array_distinct(part(rows, "label"))), ",")
    base, strongest = F.col("base"), F.coalesce(F.array_max(part(F.col("matches"), "fixed")), F.lit(0))
    return (found.withColumn("base", F.filter("matches", lambda m: m["kind"] == "phrase"))
            .select("doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"),
                    F.array_min(part(base, "first_word")).alias("first_word"),
                    F.array_max(part(base, "first_word")).alias("last_word"),
                    listed(base).alias("base_labels"), listed(F.col("matches")).alias("labels"),
                    (strongest / (strongest + HALF)).alias("score")))
