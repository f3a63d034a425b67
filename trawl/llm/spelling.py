"""Grouping of spelling variants: words one edit apart, by dynamic programming over sorted lists."""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import arrow_slices, byte_flags, read
from trawl.llm.sql import LOWER, UPPER
from trawl.operators.joins import lookup_join
from trawl.sources.shared import write_shared

LEAST_LENGTH, LEAST_COUNT = 5, 3
#: Of so many runs in a document one is misspelt, as the query asks for.
MISSPELT = 97
#: A form is at least so many times as frequent as its variant.
RATIO = 2
#: Words of one shard of a sorted list, unless that gave more than so many shards.
SHARD_WORDS, MOST_SHARDS = 4_000, 20_000
#: Words drawn for each shard to place the shards' bounds by; results do not hang on them.
DRAWN = 16
LAST = "\U0010ffff"
#: Any number of edits beyond one.
FAR = 2
#: Signs of words that are scanned many at a time, and queries scanned together.
WIDTH, BLOCK = 64, 2_000


# --- one query against a sorted list ----------------------------------------------------------

def common_prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def next_row(row: tuple[int, int, int], sign: str, query: str, depth: int) -> tuple[int, int, int]:
    """The band of the edit matrix after one more sign of a listed word.

    A row has the edits between the word's first ``depth`` signs and the query's first ``depth - 1``,
    ``depth`` and ``depth + 1``.
    """
    before, same, after = row
    size = len(query)
    a = min(before + (depth < 1 or query[depth - 1] != sign), same + 1) if depth <= size else FAR
    b = min(same + (query[depth] != sign), after + 1, a + 1) if depth < size else FAR
    c = min(after + (query[depth + 1] != sign), b + 1) if depth + 1 < size else FAR
    return a, b, c


def first_row(query: str, exact: int) -> tuple[int, int, int]:
    """The band after ``exact`` signs that the word and the query share."""
    return (1 if exact else FAR, 0, 1 if exact < len(query) else FAR)


def within_reach(query: str, exact: int, prefix: str) -> bool:
    """Whether a word with this prefix may be one edit from the query, of which it shares ``exact`` signs."""
    row = first_row(query, exact)
    for depth in range(exact, len(prefix)):
        row = next_row(row, prefix[depth], query, depth)
        if min(row) > 1:
            return False
    return True


def near_words(words: list[str], shared: list[int], query: str, exact: int) -> Iterator[int]:
    """Places in the sorted ``words`` of those that begin with the query's first ``exact`` signs and are one edit from it.

    ``shared`` has the length of the prefix that each word shares with the one before it. Rows of the
    matrix up to that length hold for both and are kept. Where no cell of a row is below two edits, all
    words with the prefix read so far are skipped.
    """
    start = query[:exact]
    i, end = bisect_left(words, start), bisect_left(words, start + LAST)
    rows = [first_row(query, exact)]
    depth = exact
    while i < end:
        word = words[i]
        del rows[depth - exact + 1:]
        row = rows[-1]
        while depth < len(word):
            row = next_row(row, word[depth], query, depth)
            if min(row) > 1:
                break
            rows.append(row)
            depth += 1
        if depth == len(word):
            apart = len(query) - len(word)
            if -1 <= apart <= 1 and row[apart + 1] == 1:
                yield i
            i += 1
        else:
            i = bisect_left(words, word[:depth + 1] + LAST, i + 1, end)
        if i < end:
            depth = max(exact, min(depth, shared[i]))


class SortedList:
    """The same for many queries at once, over words of at most ``WIDTH`` signs.

    Where words share a prefix their rows are the same, so a row is kept for a query and a range of words with a
    common prefix. A step divides ranges where adjacent words share no more than the prefix, adds
    one sign to all rows, and drops the ranges whose rows have no cell below two edits.
    """

    def __init__(self, words: list[str]):
        self.words = words
        self.codes = codes_of(words)
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.shared = np.array([0, *map(common_prefix, words, words[1:])][:len(words)], np.int64)

    def near(self, queries: list[str], exact: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of queries and places of the words near to them."""
        codes, sizes = codes_of(queries), np.array([len(q) for q in queries], np.int64)
        starts = [bisect_left(self.words, q[:e]) for q, e in zip(queries, exact)]
        ends = [bisect_left(self.words, q[:e] + LAST) for q, e in zip(queries, exact)]
        begin = np.array([range(len(queries)), starts, ends], np.int64)
        exact = np.array(exact, np.int64)
        at = np.zeros((6, 0), np.int64)
        asked, places = [at[0]], [at[0]]
        depth, deepest = 0, int(exact.max(initial=-1))
        while depth <= deepest or at.shape[1]:
            new = begin[:, (exact == depth) & (begin[1] < begin[2])]
            size = sizes[new[0]]
            rows = np.stack([np.full(len(size), 1 if depth else FAR), np.zeros(len(size), np.int64),
                             np.where(depth < size, 1, FAR)])
            at = np.concatenate([at, np.concatenate([new, rows])], axis=1)
            query, low, high, *row = at
            apart = sizes[query] - depth
            done = (self.lengths[low] == depth) & (np.abs(apart) <= 1)
            done &= np.choose(np.clip(apart, -1, 1) + 1, row) == 1
            asked.append(query[done])
            places.append(low[done])
            at = self._deeper(at, depth, codes, sizes)
            depth += 1
        return np.concatenate(asked), np.concatenate(places)

    def _deeper(self, at: np.ndarray, depth: int, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The ranges divided by their next sign, with their rows, as far as these are within reach."""
        apart = np.flatnonzero(self.shared <= depth)
        first = apart[self.lengths[apart] > depth]
        a, b = np.searchsorted(first, at[1]), np.searchsorted(first, at[2])
        parts = b - a
        query, _, high, before, same, after = np.repeat(at, parts, axis=1)
        low = first[np.arange(len(query)) - np.repeat(np.cumsum(parts) - parts, parts) + np.repeat(a, parts)]
        after_low = np.searchsorted(apart, low, "right")
        high = np.minimum(high, np.append(apart, len(self.words))[after_low])
        sign, size = self.codes[low, depth] if depth < WIDTH else low, sizes[query]
        other = lambda n: codes[query, min(max(n, 0), WIDTH - 1)] != sign
        x = np.where(depth <= size, np.minimum(before + (other(depth - 1) | (depth < 1)), same + 1), FAR)
        y = np.where(depth < size, np.minimum(np.minimum(same + other(depth), after + 1), x + 1), FAR)
        z = np.where(depth + 1 < size, np.minimum(after + other(depth + 1), y + 1), FAR)
        kept = np.minimum(np.minimum(x, y), z) <= 1
        return np.stack([query, low, high, x, y, z])[:, kept]


def codes_of(words: list[str]) -> np.ndarray:
    """Code points of words of at most ``WIDTH`` signs, a row each, filled up with 0."""
    return np.array(words, f"<U{WIDTH}").view(np.uint32).reshape(-1, WIDTH)


def nearest(words: list[str], counts: list[int], queries: list[str], backwards: bool) -> Iterator[tuple]:
    """``(word, n_near, near_n, near)`` of the queries with near words in one shard's sorted ``words``."""
    turned = (lambda w: w[::-1]) if backwards else (lambda w: w)
    counts = np.array(counts, np.int64)
    # In order of the words as they are written, which decides among equally frequent ones.
    place = np.empty(len(words), np.int64)
    place[sorted(range(len(words)), key=lambda i: turned(words[i]))] = np.arange(len(words))
    short = [i for i, w in enumerate(words) if len(w) <= WIDTH]
    long = [i for i, w in enumerate(words) if len(w) >= WIDTH - 1]
    listed = SortedList([words[i] for i in short])
    few = [q for q in queries if len(q) < WIDTH]
    asked, near = [], []
    for at in range(0, len(few), BLOCK):
        part = few[at:at + BLOCK]
        q, w = listed.near(part, [halves(turned(p))[backwards][1] for p in part])
        asked.append(q + at)
        near.append(np.array(short, np.int64)[w])
    many = [q for q in queries if len(q) >= WIDTH]
    if many:
        rest = [words[i] for i in long]
        shared = [0, *map(common_prefix, rest, rest[1:])]
        for n, q in enumerate(many, len(few)):
            found = [long[i] for i in near_words(rest, shared, q, halves(turned(q))[backwards][1])]
            asked.append(np.full(len(found), n, np.int64))
            near.append(np.array(found, np.int64))
    if not asked:
        return
    own, asked, near = few + many, np.concatenate(asked), np.concatenate(near)
    if backwards and len(asked):  # those with the whole first half in common stand in the other list too
        kept = [common_prefix(own[q][::-1], words[w][::-1]) < len(own[q]) // 2
                for q, w in zip(asked.tolist(), near.tolist())]
        asked, near = asked[kept], near[kept]
    order = np.lexsort((place[near], -counts[near], asked))
    asked, near = asked[order], near[order]
    first = np.flatnonzero(np.append(True, np.diff(asked) != 0)) if len(asked) else asked
    for n, q, w in zip(np.diff(np.append(first, len(asked))).tolist(), asked[first].tolist(), near[first].tolist()):
        yield turned(own[q]), n, int(counts[w]), turned(words[w])


# --- the sorted lists in shards ---------------------------------------------------------------

def halves(word: str) -> tuple[tuple[str, int], tuple[str, int]]:
    """The word for the list in order and for the list of reversed words, each with the signs that must be the same.

    Of two words one edit apart, the edit lies either beyond the first half of the one, or within it and the rest
    is the same to the end.
    """
    half = len(word) // 2
    return (word, half), (word[::-1], len(word) - half)


def shard_bounds(words: DataFrame, total: int, shard_words: int) -> tuple[list[str], list[str]]:
    """First words of the shards but the first, of both lists.

    They come from words drawn by hash, at most DRAWN * MOST_SHARDS of them.
    """
    shards = min(total // shard_words + 1, MOST_SHARDS)
    if shards == 1:
        return [], []
    step = max(1, total // (shards * DRAWN))
    drawn = [r["word"] for r in words.where(F.pmod(F.xxhash64("word"), F.lit(step)) == 0).select("word").collect()]
    lists = sorted(drawn), sorted(w[::-1] for w in drawn)
    return tuple(sorted({own[n * len(own) // shards] for n in range(1, shards)}) if own else [] for own in lists)


def shards_to_ask(query: str, exact: int, bounds: list[str], prefixes: list[str]) -> Iterator[int]:
    """Shards with words that share the query's first ``exact`` signs and may be one edit from it."""
    start = query[:exact]
    first, last = bisect_right(bounds, start), bisect_right(bounds, start + LAST)
    for shard in range(first, last + 1):
        if not (first < shard < last) or within_reach(query, exact, prefixes[shard]):
            yield shard


ROUTED = "list int, shard int, word string, n bigint, listed boolean"
FOUND = "word string, n_near bigint, near_n bigint, near string"


def near_in_shards(words: DataFrame, total: int, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``(word, n_near, near_n, near)``: of each word and shard the number of near words and the most frequent.

    ``words (word, n)`` are distinct. Each is listed in one shard of either list, and asks the shards that may have
    words near to it. A pair of near words is found in exactly one list, as the edit is either in the
    first half of the word that asks or not.
    """
    bounds = shard_bounds(words, total, shard_words)
    # All words of a shard between two bounds share what the bounds share.
    prefixes = [["", *[a[:common_prefix(a, b)] for a, b in zip(own, own[1:])], ""] for own in bounds]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for which, (key, exact) in enumerate(halves(word)):
                    own = bisect_right(bounds[which], key)
                    rows.append((which, own, key, n, True))
                    rows += [(which, s, key, n, False)
                             for s in shards_to_ask(key, exact, bounds[which], prefixes[which]) if s != own]
            types = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(list(zip(*rows)) or [()] * 5, types)],
                                             names=["list", "shard", "word", "n", "listed"])

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        entries = sorted(zip(*(table.column(c).to_pylist() for c in ("word", "n", "listed"))))
        listed = [e for e in entries if e[2]]
        rows = list(nearest([w for w, _, _ in listed], [n for _, n, _ in listed], [w for w, _, _ in entries],
                            key[0].as_py() == 1))
        types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        return pa.table([pa.array(v, t) for v, t in zip(list(zip(*rows)) or [()] * 4, types)],
                        names=["word", "n_near", "near_n", "near"])

    routed = words.select("word", "n").mapInArrow(route, ROUTED)
    return routed.groupBy("list", "shard").applyInArrow(ask, FOUND)


# --- forms and roots --------------------------------------------------------------------------

def spelling_variants(words: DataFrame, ratio: int = RATIO, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of distinct ``words (word, n)``.

    Two words are near if one inserted, deleted or replaced code point makes the one the other. ``form`` is the near
    word of largest ``n``, of several the first in code-point order, if it is at least ``ratio`` times as frequent as
    the word, else null; ``root`` is the last in the chain of forms, the word itself if it has none.

    Both lists are cut into shards of about ``shard_words`` words, so that a prefix that very many words share spans
    shards, and only those within one edit of a word are asked for it. Words without any sign are near to words of one. Words
    must not be null; no words give no rows. Further columns are left out.
    """
    words = words.select("word", F.col("n").cast("bigint").alias("n"))
    total = words.count()
    shard_words = max(shard_words, -(-total // MOST_SHARDS))
    found = near_in_shards(words, total, shard_words)
    none = F.lit(None)
    both = (words.select("word", "n", F.lit(0).cast("bigint").alias("n_near"), none.cast("bigint").alias("near_n"),
                         none.cast("string").alias("near"))
            .unionByName(found.select("word", none.cast("bigint").alias("n"), "n_near", "near_n", "near")))
    # A struct without a near word would come first, so it is none.
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("order"), "near")))
    merged = both.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    accepted = -F.col("best.order") >= ratio * F.col("n")
    forms = write_shared(merged.select("word", "n", "n_near", F.when(accepted, F.col("best.near")).alias("form"),
                                       F.when(accepted, -F.col("best.order")).alias("form_n")), "forms")
    roots = _roots(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return (forms.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def _roots(links: DataFrame) -> DataFrame:
    """``(word, root)`` of ``links (word, root)``, each followed to the last.

    Forms grow at least ``ratio`` times as frequent from link to link, so there is no circle. A round doubles the links
    that are followed; the last changes nothing.
    """
    links = write_shared(links, "roots")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        joined = lookup_join(links, further, "root", ["word"], "left")
        links = write_shared(joined.select("word", F.coalesce("beyond", "root").alias("root"),
                                           F.col("beyond").isNotNull().alias("moved")), "roots")
        if links.where("moved").isEmpty():
            return links.select("word", "root")
        links = links.drop("moved")


# --- words of documents -----------------------------------------------------------------------

#: The first byte of the letters from U+00C0 to U+00FF in UTF-8, which have one byte more.
LATIN = 0xC3
LETTERS = byte_flags((UPPER + LOWER).encode() + bytes([LATIN]))
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[list(UPPER.encode())] = list(LOWER.encode())
#: Runs of more bytes are hashed one by one.
COLUMNS = 64
#: Words that a task counts before it sends them on.
HELD_WORDS = 300_000
CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    CRC = (CRC >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (CRC & np.uint32(1)))


class Runs:
    """Maximal runs of Latin letters of texts, A-Z lower-cased: the bytes of all, and of each its bounds and its text."""

    def __init__(self, texts: list[str]):
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
        flags = LETTERS[data]
        flags[1:] |= data[:-1] == LATIN
        edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0))
        starts, ends = edges[0::2], edges[1::2]
        self.bytes = LOWERED[data[flags]]
        self.lengths = ends - starts
        self.firsts = np.concatenate(([0], np.cumsum(self.lengths)))
        self.text = np.searchsorted(np.cumsum([len(r) + 1 for r in raw]), starts, "right")

    def checksums(self, prefixes: list[bytes]) -> np.ndarray:
        """crc32 of each run after its text's prefix."""
        begun = np.array([zlib.crc32(p) for p in prefixes], np.uint32)[self.text] ^ np.uint32(0xFFFFFFFF)
        order = np.argsort(-self.lengths, kind="stable")
        long = int(np.count_nonzero(self.lengths > COLUMNS))
        state, first, size = begun[order], self.firsts[:-1][order], self.lengths[order]
        for n in range(min(int(size.max(initial=0)), COLUMNS)):
            reach = int(np.searchsorted(-size, -n, "left"))  # so many are longer than n
            now = state[long:reach]
            state[long:reach] = CRC[(now ^ self.bytes[first[long:reach] + n]) & np.uint32(255)] ^ (now >> np.uint32(8))
        found = np.empty(len(state), np.uint32)
        found[order] = state ^ np.uint32(0xFFFFFFFF)
        for i in order[:long].tolist():
            found[i] = zlib.crc32(self.word(i), zlib.crc32(prefixes[self.text[i]]))
        return found

    def word(self, i: int) -> bytes:
        return self.bytes[self.firsts[i]:self.firsts[i + 1]].tobytes()

    def counted(self, chosen: np.ndarray) -> tuple[list[str], list[int]]:
        """Distinct runs among the chosen, and how many there are of each."""
        kept = self.bytes[np.repeat(chosen, self.lengths)]
        offsets = np.concatenate(([0], np.cumsum(self.lengths[chosen]))).astype(np.int64)
        values = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(kept))
        found = pc.value_counts(values)
        return found.field("values").to_pylist(), found.field("counts").to_pylist()


def words_of(texts: list[str], keys: list[str], least_length: int, one_in: int) -> Counter:
    """Words of the texts, some misspelt, with their numbers; those of too few code points are left out."""
    runs = Runs(texts)
    found: Counter = Counter()
    if not len(runs.lengths):
        return found
    sums = runs.checksums([f"{k}:".encode() for k in keys])
    changed = sums % np.uint32(one_in) == 0
    marks = np.concatenate(([0], np.cumsum(runs.bytes == LATIN)))
    points = runs.lengths - np.diff(marks[runs.firsts])
    for word, n in zip(*runs.counted(~changed & (points >= least_length))):
        found[word] += n
    for i in np.flatnonzero(changed & (points > least_length)).tolist():
        word, at = runs.word(i).decode(), int(sums[i] % points[i])
        found[word[:at] + word[at + 1:]] += 1
    return found


def frequent_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
                   least_count: int = LEAST_COUNT, one_in: int = MISSPELT) -> DataFrame:
    """``(word, n)``: words of so many code points and occurrences or more in all texts.

    Words are maximal runs of Latin letters to U+00FF with A-Z, and nothing else, lower-cased. Of a run whose crc32 after
    the document's id and a colon is divisible by ``one_in``, one code point is left out, the checksum's
    remainder by the length; a null id counts as empty. Null and empty texts have no words, repeated rows count as often as they
    stand there, texts are read whole. Words are counted in each task before they move.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def sent() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                               names=["word", "n"])
            held.clear()
            return batch
        for batch in batches:
            keys, at = batch.column(0).fill_null(""), 0
            for texts in arrow_slices(batch.column(1)):
                held.update(words_of(texts, keys.slice(at, len(texts)).to_pylist(), least_length, one_in))
                at += len(texts)
                if len(held) >= HELD_WORDS:
                    yield sent()
        yield sent()

    counted = docs.select(F.col(id_col).cast("string"), F.col(text_col)).mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def op12_spelling(spark, sf_dir):
    words = frequent_words(read(spark, sf_dir, "documents"))
    return spelling_variants(write_shared(words, "words"))
