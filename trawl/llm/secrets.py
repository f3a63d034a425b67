"""Secrets in texts: fixed forms, and strings of high entropy."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import read, text_function

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Order of kinds that begin at the same place.
KINDS = ["assign", "access", "hex", "entropy_hex", "entropy_base64"]
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")


@dataclass(frozen=True)
class CharacterClass:
    """Windows of ``window`` characters with ``bits`` of entropy or more, of any run of a candidate, are secret."""

    kind: str
    run: re.Pattern
    window: int
    bits: float


CLASSES = [
    CharacterClass("entropy_hex", re.compile(r"[0-9a-fA-F]{20,}"), 20, 3.0),
    CharacterClass("entropy_base64", re.compile(r"[A-Za-z0-9+/_-]+={0,2}"), 20, 3.9),
]

#: Candidates that are no secrets: numbers, marks, UUIDs.
ALLOWED = [re.compile(p) for p in (
    r"[0-9]+", r"[-_/+=]+",
    r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
)]
#: And these where their letters read like words: words or numbers joined by marks, capitalised words run together.
WORDED = [re.compile(p) for p in (
    r"(?:[A-Za-z]+|[0-9]+)(?:[-_/+]+(?:[A-Za-z]+|[0-9]+))*[-_/+=]*",
    r"(?:[A-Z][a-z]{2,})+[0-9]{0,2}",
)]
#: Pairs of letters that make up most of the words of European languages, but under a quarter of random letters.
PAIRS = frozenset("""ab ac ad af ah ai al am an ap ar as at au ba be bi bl bo br ca ce ch ci ck cl co ct de di do ea ec ed ee ef
eh ei el em en ep er es et eu ex ff fi fo fr fu ge gr ha he hi ho hr ht ic id ie if ig il im in io ir is it iv ke ki la le li ll lo ls
lt lu ly ma me mi mm mo mp na nc nd ne ng ni nn no ns nt oc od of ol om on oo op or os ot ou ow pa pe ph pl po pp pr qu ra re ri rn
ro rr rs rt ru ry sc se sh si so sp ss st su ta te th ti to tr ts tt tu tz ue ui ul um un up ur us ut va ve vi vo wa we wi""".split())
#: Runs of letters of this length are judged one by one besides all together.
LONG_RUN = 10
LETTERS, PARTS = re.compile(r"[A-Za-z]+"), re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """``(start, kind, end)`` of the fixed forms; each kind leftmost and without overlap."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return found


def high_windows(value: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Stretches of ``value`` covered by windows of at least ``bits`` of Shannon entropy.

    A window's entropy is ``log2(window) - sum(n * log2(n)) / window`` over its character
    counts. A step takes one character out and one in, so only two terms of the sum change.
    """
    term = [0.0] + [n * math.log2(n) for n in range(1, window + 1)]
    most = (math.log2(window) - bits) * window + 1e-9
    counts = Counter(value[:window])
    total, found = sum(term[n] for n in counts.values()), []
    for end in range(window, len(value) + 1):
        if total <= most:
            start = end - window
            if found and start <= found[-1][1]:
                found[-1] = (found[-1][0], end)
            else:
                found.append((start, end))
        if end < len(value):
            for c, step in ((value[end - window], -1), (value[end], 1)):
                total -= term[counts[c]]
                counts[c] += step
                total += term[counts[c]]
    return found


def words(runs: list[str]) -> bool:
    """Whether runs of letters read like words: few changes of case, and half the pairs of letters common or in alphabetic order."""
    parts = [p.lower() for r in runs for p in PARTS.findall(r)]
    pairs = [p[n:n + 2] for p in parts for n in range(len(p) - 1)]
    common = sum(p in PAIRS for p in pairs)
    in_order = sum(ord(p[1]) - ord(p[0]) == 1 for p in pairs)
    return (3 * (len(parts) - len(runs)) <= sum(map(len, runs))
            and (2 * common >= len(pairs) or 10 * in_order >= 8 * len(pairs)))


def allowed(value: str) -> bool:
    if any(a.fullmatch(value) for a in ALLOWED):
        return True
    if not any(a.fullmatch(value) for a in WORDED):
        return False
    runs = LETTERS.findall(value)
    return words(runs) and all(words([r]) for r in runs if len(r) >= LONG_RUN)


def entropy_spans(text: str) -> list[tuple[int, str, int]]:
    """Stretches of high entropy in the runs of each class; those of a candidate that meet are one, of the first's kind."""
    found = []
    for m in CANDIDATE.finditer(text):
        if allowed(m.group()):
            continue
        own = sorted((m.start() + run.start() + a, n, m.start() + run.start() + b) for n, c in enumerate(CLASSES)
                     for run in c.run.finditer(m.group()) if not allowed(run.group())
                     for a, b in high_windows(run.group(), c.window, c.bits))
        at = len(found)
        for start, n, end in own:
            if len(found) > at and start <= found[-1][2]:
                found[-1] = (*found[-1][:2], max(found[-1][2], end))
            else:
                found.append((start, CLASSES[n].kind, end))
    return found


def spans(text: str) -> tuple[list, list]:
    """Base spans and all spans, in order. A span of high entropy inside a base span adds nothing and is left out."""
    def order(span):
        return span[0], KINDS.index(span[1])
    base = sorted(base_spans(text), key=order)
    more = [s for s in entropy_spans(text) if not any(a <= s[0] and s[2] <= b for a, _, b in base)]
    return base, sorted(base + more, key=order)


def written(found: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in found)


def scan_texts(texts: list[str]) -> list:
    columns: list[list] = [[] for _ in range(5)]
    for text in texts:
        base, every = spans(text)
        kinds = Counter(kind for _, kind, _ in base)
        row = (*(kinds[k] for k in KINDS[:3]), hashlib.sha256(written(base).encode()).hexdigest(), written(every))
        for column, value in zip(columns, row):
            column.append(value)
    return columns


def redact_texts(texts: list[str]) -> list:
    """Texts with every stretch of overlapping spans replaced by the kind of the first in brackets."""
    out = []
    for text in texts:
        parts, at = [], 0
        for start, kind, end in spans(text)[1]:
            if start >= at:
                parts += [text[at:start], f"[{kind}]"]
            at = max(at, end)
        out.append("".join(parts) + text[at:])
    return [out]


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` and ``spans`` in place of columns of these names.

    Offsets count code points, ends are exclusive. Null and empty texts have no spans. The
    whole text is searched. Spans that begin together are in the order of ``KINDS``. Repeated
    rows, null ids and other columns stay as they are; an empty table gives an empty result.
    """
    names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    found = text_function(scan_texts, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
                          names, [pa.int64()] * 3 + [pa.string()] * 2)
    return docs.withColumn("__trawl_found", found(text_col)).withColumns({c: F.col(f"__trawl_found.{c}") for c in names}).drop("__trawl_found")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the secrets in their texts replaced by their kind in brackets; a null text stays null."""
    done = text_function(redact_texts, "text string", ["text"], [pa.string()])
    return (docs.withColumn("__trawl_found", done(text_col))
            .withColumn(text_col, F.when(F.col(text_col).isNotNull(), F.col("__trawl_found.text"))).drop("__trawl_found"))


def op7_secrets(spark, sf_dir):
    return scan(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
