"""Benchmark passages in training documents, found in suffix arrays of the documents."""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import ALPHANUMERIC, read, text_function
from trawl.sources.shared import write_shared

WINDOW = 10
#: Words that open a suffix; stretches of a document in which no test text has them are left out.
OPENING = 3
#: Test texts that are searched in one pass, in bytes; they go to every executor.
BLOCK_BYTES = 32_000_000
#: Characters of documents in one suffix array.
SHARD_CHARS = 4_000_000

#: Bytes of words (lower-cased), all others a blank.
FOLD = bytes(c if ALPHANUMERIC[c] else ord(chr(c).lower()) if 65 <= c <= 90 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(FOLD).split()


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes of a text of word numbers in order of their first ``depth`` words or more.

    Each round doubles the words by which suffixes are ranked.
    """
    rank = np.unique(text, return_inverse=True)[1] + 1
    n, seen = len(text), 1
    while seen < depth and rank.max() < n:
        follows = np.zeros(n, np.int64)
        follows[:n - seen] = rank[seen:]
        rank = np.unique(rank * (n + 1) + follows, return_inverse=True)[1] + 1
        seen *= 2
    return np.argsort(rank, kind="stable")


class TestTexts:
    """Test texts as one array of word numbers, 0 after each, with the windows that are looked for.

    A window is ``window`` words of a text, or the whole of a shorter one.
    """

    __test__ = False

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        split = [(item, words_of(text)) for item, text in sorted(set(items))]
        split = [(item, words) for item, words in split if words]
        self.number = {w: n for n, w in enumerate(sorted({w for _, words in split for w in words}), 1)}
        self.items = [item for item, _ in split]
        sizes = np.array([len(words) for _, words in split], np.int64)
        self.firsts = np.cumsum(sizes + 1) - sizes - 1
        self.text = np.zeros(int((sizes + 1).sum()) + window, np.int64)
        for (_, words), first in zip(split, self.firsts):
            self.text[first:first + len(words)] = [self.number[w] for w in words]
        width = np.minimum(sizes, window)
        self.starts = np.concatenate([np.arange(f, f + n - w + 1) for f, n, w in zip(self.firsts, sizes, width)]
                                     or [np.zeros(0, np.int64)])
        self.item = np.repeat(np.arange(len(split)), sizes - width + 1)
        self.width = width[self.item] if len(split) else np.zeros(0, np.int64)
        self.longest = int(sizes.max()) if len(split) else 0
        self.opening = int(min(OPENING, width.min())) if len(split) else 1
        while self.opening > 1 and (len(self.number) + 1) ** self.opening >= 1 << 62:
            self.opening -= 1
        # Of all places, not of windows only, so that a match is covered to its end.
        self.openings = np.unique(self._openings(self.text))

    def _openings(self, text: np.ndarray) -> np.ndarray:
        """A number for the first words at each place, -1 where one of them is in no test text."""
        size = len(text) - self.opening + 1
        key, known = np.zeros(max(0, size), np.int64), np.ones(max(0, size), bool)
        for n in range(self.opening):
            part = text[n:n + size]
            key = key * (len(self.number) + 1) + part
            known &= part > 0
        return np.where(known, key, -1)

    def search(self, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in a shard's text and in the test texts, and lengths, of the longest verbatim matches.

        The shard keeps the stretches in which test texts have the same opening words. Their
        suffixes are sorted, and every window of a test text is located by binary search. Windows
        found one after the other on both sides are one match.
        """
        none = np.zeros(0, np.int64)
        keys = self._openings(shard)
        at = np.flatnonzero(keys > 0)
        at = at[np.isin(keys[at], self.openings)]
        if not len(at):
            return none, none, none
        cover = np.zeros(len(shard), bool)
        for n in range(self.opening):
            cover[at + n] = True
        kept = np.flatnonzero(cover)
        gaps = np.flatnonzero(np.diff(kept) > 1) + 1
        place = np.append(np.insert(kept, gaps, -1), -1)
        text = np.append(np.insert(shard[kept], gaps, 0), 0)
        order = suffix_array(text, self.longest)
        text = np.append(text, np.zeros(int(self.width.max()), np.int64))
        low = self._bound(text, order, False)
        high = self._bound(text, order, True)
        found = high - low
        which = np.repeat(np.arange(len(self.starts)), found)
        if not len(which):
            return none, none, none
        offset = np.arange(len(which)) - np.repeat(np.cumsum(found) - found, found)
        here, there = order[low[which] + offset], self.starts[which]
        sort = np.lexsort((here, here - there))
        here, there, which = here[sort], there[sort], which[sort]
        first = np.append(True, (np.diff(here) != 1) | (np.diff(there) != 1))
        runs = np.diff(np.append(np.flatnonzero(first), len(here)))
        return place[here[first]], there[first], runs - 1 + self.width[which[first]]

    def _bound(self, text: np.ndarray, order: np.ndarray, after: bool) -> np.ndarray:
        """Binary search of all windows at once: how many suffixes are smaller, or do not exceed the window."""
        low, high = np.zeros(len(self.starts), np.int64), np.full(len(self.starts), len(order))
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            suffix, window = order[middle], self.starts[open_]
            sign = np.zeros(len(open_), np.int64)
            for n in range(int(self.width.max())):
                tied = np.flatnonzero((sign == 0) & (n < self.width[open_]))
                if not len(tied):
                    break
                sign[tied] = np.sign(text[suffix[tied] + n] - self.text[window[tied] + n])
            right = (sign <= 0) if after else (sign < 0)
            low[open_[right]] = middle[right] + 1
            high[open_[~right]] = middle[~right]
        return low

    def matches(self, texts: list[str]) -> list:
        """Of each text its number of words and its longest verbatim matches with test texts."""
        numbers, get = [], self.number.get
        for text in texts:
            words = words_of(text)
            numbers.append(np.fromiter(map(get, words, repeat(0)), np.int64, len(words)))
        counts = np.array([len(n) for n in numbers], np.int64)
        firsts = np.cumsum(counts + 1) - counts - 1
        shard = np.zeros(int((counts + 1).sum()), np.int64)
        for first, own in zip(firsts, numbers):
            shard[first:first + len(own)] = own
        found: list[list] = [[] for _ in texts]
        if len(self.starts):
            here, there, length = self.search(shard)
            doc = np.searchsorted(firsts, here, "right") - 1
            item = np.searchsorted(self.firsts, there, "right") - 1
            for d, i, start, item_start, n in zip(
                    doc.tolist(), item.tolist(), (here - firsts[doc]).tolist(),
                    (there - self.firsts[item]).tolist(), length.tolist()):
                found[d].append({"item_id": self.items[i], "item_start": item_start, "start": start, "length": n})
        return [counts, found]


MATCH = "struct<item_id: string, item_start: int, start: int, length: int>"
MATCH_ARROW = pa.list_(pa.struct([("item_id", pa.string()), ("item_start", pa.int32()), ("start", pa.int32()),
                                  ("length", pa.int32())]))


def test_blocks(tests: DataFrame, id_col: str, text_col: str, window: int):
    """``TestTexts`` of all test texts, block by block; a block is of ``BLOCK_BYTES`` or so."""
    known = tests.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    size = known.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = size // BLOCK_BYTES + 1
    for n in range(blocks):
        part = known.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == n)
        yield TestTexts([(r["id"], r["text"]) for r in part.collect()], window)


def find_matches(docs: DataFrame, tests: DataFrame, text_col: str = "text", test_id: str = "item_id",
                 test_text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with ``n_words`` and ``matches``, all longest verbatim matches of a window or more.

    A match tells the test text, the place in it, the place in the document and the length,
    in words. Words are runs of digits, of letters, A-Z lower-cased, and of all characters
    beyond ASCII. A test text of fewer than ``window`` words has to occur whole; one without
    words or id matches nothing. The documents of a batch make one shard with its own suffix
    array, so nothing is exchanged, and a passage in very many documents is found in each
    shard by itself. Null and empty documents have no words. Texts are searched whole. Repeated
    test rows count once; repeated documents, null ids and other columns stay. Empty tables give
    no matches.
    """
    context = docs.sparkSession.sparkContext
    found = docs.withColumns({"n_words": F.lit(0).cast("bigint"), "matches": F.array().cast(f"array<{MATCH}>")})
    for n, block in enumerate(test_blocks(tests, test_id, test_text, window)):
        shared = context.broadcast(block)
        search = text_function(lambda texts, shared=shared: shared.value.matches(texts),
                               f"n_words bigint, matches array<{MATCH}>", ["n_words", "matches"],
                               [pa.int64(), MATCH_ARROW], SHARD_CHARS)
        if n:  # more than one block: what was found so far is kept in a table
            found = write_shared(found, "matches")
        found = (found.withColumn("__trawl_found", search(text_col)).withColumn("n_words", F.col("__trawl_found.n_words"))
                 .withColumn("matches", F.concat("matches", "__trawl_found.matches")).drop("__trawl_found"))
    return found


def covered(matches):
    """Words inside any of the matches."""
    spans = F.array_sort(F.transform(matches, lambda m: F.struct(m["start"].alias("a"),
                                                                  (m["start"] + m["length"]).alias("b"))))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    return F.aggregate(spans, start, lambda held, s: F.struct(
        (held["n"] + F.greatest(F.lit(0), s["b"] - F.greatest(s["a"], held["upto"]))).alias("n"),
        F.greatest(held["upto"], s["b"]).alias("upto")))["n"]


def contamination(found: DataFrame) -> DataFrame:
    """Adds ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated`` and ``longest`` to ``find_matches``."""
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"])))
    return (found.withColumn("__trawl_items", items)
            .withColumns({"n_hit": covered(F.col("matches")).cast("bigint"),
                          "n_items": F.size("__trawl_items").cast("bigint"),
                          "items_sha256": F.sha2(F.array_join("__trawl_items", ","), 256),
                          "longest": F.coalesce(F.array_max(F.transform("matches", lambda m: m["length"])), F.lit(0))})
            .withColumn("contaminated", F.col("n_hit") > 0).drop("__trawl_items"))


def decontaminate(docs: DataFrame, tests: DataFrame, text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs`` without a match, with all their columns."""
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    return find_matches(rows, tests, **kw).where(F.size("matches") == 0).select("row.*")


def op4_decontamination(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(find_matches(docs, read(spark, sf_dir, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest")
