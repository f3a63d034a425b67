"""Near-duplicate documents: MinHash with tensored banding, verified on whole shingle sets."""

from __future__ import annotations

import hashlib
import math
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import UNSPACED, Words, ascii_lower, mix, read, text_function
from trawl.llm.components import components
from trawl.llm.repeats import rolled
from trawl.operators.joins import BROADCAST_BYTES, ROW_BYTES, lookup_join, spread_join
from trawl.sources.shared import write_shared

SHINGLE_WORDS, PERCENT = 5, 80
#: Minimum hashes in each half of a table's key.
HALF = 2
#: Chance that a pair just at the threshold has no table in common, at most.
MISS = 1e-4
#: Rounds at most that link groups of one table by single pairs before all pairs between groups are tried.
STAR_ROUNDS = 2
SLICE = 500_000


def halves_needed(percent: int, half: int = HALF, miss: float = MISS) -> int:
    """Halves per collection, so that both collections agree somewhere with a chance of ``1 - miss``."""
    agree = (percent / 100) ** half
    return max(1, math.ceil(math.log(miss / 2) / math.log(1 - agree))) if agree < 1 else 1


def shingle_sets(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of all texts, in order within each, and where each text's begin.

    A text of fewer words than ``size`` has its whole word sequence as one shingle.
    """
    words = Words([ascii_lower(t) for t in texts], UNSPACED)
    n = max(0, len(words.starts) - size + 1)
    at = np.flatnonzero(words.text[:n] == words.text[size - 1:size - 1 + n])
    hashes = rolled(words.hashes, size)[at] if n else np.zeros(0, np.uint64)
    text = words.text[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(short):
        whole = [rolled(words.hashes[words.firsts[t]:words.firsts[t + 1]], int(words.counts[t]))[0] for t in short]
        whole = mix(np.array(whole, np.uint64) + words.counts[short].astype(np.uint64))
        hashes, text = np.concatenate([hashes, whole]), np.concatenate([text, short])
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    if len(hashes):
        new = np.append(True, (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1]))
        hashes, text = hashes[new], text[new]
    return hashes, np.searchsorted(text, np.arange(len(texts) + 1))


def signatures(size: int, halves: int, half: int):
    """Number of shingles, digest of the set, and the keys of both collections' halves, of each text."""
    rng = np.random.default_rng(20)
    shifts = rng.integers(0, 1 << 63, (2, halves, half), dtype=np.uint64)
    factors = rng.integers(0, 1 << 63, (2, halves, half), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def compute(texts: list[str]) -> list:
        hashes, bounds = shingle_sets(texts, size)
        counts = np.diff(bounds)
        full = np.flatnonzero(counts)
        keys = np.zeros((2, len(texts), halves), np.uint64)
        for side in range(2):
            for n in range(halves):
                for k in range(half):
                    if len(full):
                        least = np.minimum.reduceat((hashes ^ shifts[side, n, k]) * factors[side, n, k], bounds[full])
                        keys[side, full, n] = mix(keys[side, full, n] * np.uint64(3) + least)
        digests = [hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest() for a, b in zip(bounds, bounds[1:])]
        return [counts, digests, *(list(side.view(np.int64)) for side in keys)]
    return text_function(compute, "n_shingles bigint, digest binary, left array<bigint>, right array<bigint>",
                         ["n_shingles", "digest", "left", "right"],
                         [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())], SLICE)


def tables(classes: DataFrame) -> DataFrame:
    """``(key, id)``: one row per class and pair of a left and a right half."""
    return (classes.select("id", "right", F.posexplode("left").alias("i", "x"))
            .select("id", "i", "x", F.posexplode("right").alias("j", "y"))
            .select(F.xxhash64("i", "j", "x", "y").alias("key"), "id"))


# --- verification -----------------------------------------------------------------------------

def squeezed():
    def squeeze(texts: list[str]) -> list:
        made = zstandard.ZstdCompressor(level=1)
        return [[made.compress(t.encode()) for t in texts]]
    return text_function(squeeze, "blob binary", ["blob"], [pa.binary()])


def unsqueezed(blob: bytes) -> str:
    return zstandard.ZstdDecompressor().decompress(blob).decode()


def linked(pairs: DataFrame, blobs: DataFrame, size: int, percent: int) -> DataFrame:
    """The ``pairs (a, b)`` whose full shingle sets have ``100 * common >= percent * union``.

    Pairs of an id with very many partners are split over tasks.
    """
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: OrderedDict = OrderedDict()

        def sets(key: int, blob: bytes) -> np.ndarray:
            if key not in held:
                held[key] = shingle_sets([unsqueezed(blob)], size)[0]
                if len(held) > 32:
                    held.popitem(last=False)
            held.move_to_end(key)
            return held[key]

        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = []
            for n in range(len(a)):
                x, y = sets(a[n], batch.column(2)[n].as_py()), sets(b[n], batch.column(3)[n].as_py())
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                if 100 * common >= percent * (len(both) - common):
                    keep.append(n)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep, pa.int64())) for c in (0, 1)],
                                             names=["a", "b"])

    right = blobs.select(F.col("id").alias("b"), F.col("blob").alias("blob_b"))
    left = blobs.select(F.col("id").alias("a"), F.col("blob").alias("blob_a"))
    loads = pairs.groupBy("a").agg(F.count("*").alias("load"))
    both = spread_join(pairs.join(right, "b"), left, ["a"], loads, ["b"])
    return both.select("a", "b", "blob_a", "blob_b").mapInArrow(verify, "a bigint, b bigint")


def grouped_by(labels: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(key, id, c)`` with the group of each id, and ``(key, first, n)`` of the tables in which groups meet."""
    rows = (members.join(labels.withColumnRenamed("component", "c"), "id", "left")
            .withColumn("c", F.coalesce("c", "id")))
    mixed = (rows.groupBy("key").agg(F.min("c").alias("first"), F.max("c").alias("last"), F.count("*").alias("n"))
             .where("first < last").drop("last"))
    return rows, mixed


def pairs_of_groups(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs ``(a, b)``, a < b: one member of each group with one of the first group, for groups that meet in a table.

    ``members`` is ``(key, id)``, ``labels`` the group of each id in one.
    """
    grouped, mixed = grouped_by(labels, members)
    rows = grouped.join(mixed.select("key", "first"), "key")
    chosen = rows.groupBy("key", "first", "c").agg(F.min_by("id", F.xxhash64("key", "id")).alias("id"))
    heads = chosen.where("c = first").select("key", F.col("id").alias("p"))
    meeting = chosen.where("c > first").select("key", F.col("id").alias("q")).join(heads, "key")
    return meeting.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()


def plausible(percent: int, rest_a: str, size_a: str, rest_b: str, size_b: str) -> str:
    """Whether two sets can be similar that have nothing in common before the last ``rest`` of each."""
    return f"100 * least({rest_a}, {rest_b}) >= {percent} * ({size_a} + {size_b} - least({rest_a}, {rest_b}))"


def all_pairs(rare: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)``, a < b, of different groups that meet in a rare shingle and can be similar.

    At the first shingle in order of rarity that two similar sets share, what follows it has
    room for all they have in common. So groups, and then their members, are paired only where
    it has; a similar pair always is, by that shingle.
    """
    grouped, mixed = grouped_by(labels, rare)
    rows = grouped.join(mixed.select("key"), "key", "left_semi")
    groups = rows.groupBy("key", "c").agg(F.max("rest").alias("rest"), F.min("size").alias("size"))
    others = groups.select(F.col("key").alias("k"), F.col("c").alias("d"), F.col("rest").alias("rest_d"), F.col("size").alias("size_d"))
    met = groups.join(others, (F.col("key") == F.col("k")) & (F.col("c") < F.col("d"))
                      & F.expr(plausible(percent, "rest", "size", "rest_d", "size_d"))).select("key", "c", "d")
    left = rows.select("key", "c", F.col("id").alias("p"), F.col("rest").alias("rest_p"), F.col("size").alias("size_p"))
    right = rows.select(F.col("key").alias("k"), F.col("c").alias("e"), F.col("id").alias("q"),
                        F.col("rest").alias("rest_q"), F.col("size").alias("size_q"))
    pairs = met.join(left, ["key", "c"]).join(
        right, (F.col("key") == F.col("k")) & (F.col("d") == F.col("e"))
        & F.expr(plausible(percent, "rest_p", "size_p", "rest_q", "size_q")))
    return pairs.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()


def rare_shingles(blobs: DataFrame, ids: DataFrame, size: int, percent: int) -> DataFrame:
    """``(key, id, size, rest)``: of each document the rarest shingles, of which a similar one must have one.

    ``size`` is the number of its shingles, ``rest`` of those from this one on in order of rarity.

    If two sets of n and m shingles are similar, so many of the n are common that among the
    ``n - ceil(percent * n / 100) + 1`` rarest of either there is one that both have. Rarity is
    counted over the given documents. Shingles of one document only take places but meet
    nothing, so they are not returned.
    """
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                ids = batch.column(0).slice(at, 256).to_numpy()
                texts = [unsqueezed(b) for b in batch.column(1).slice(at, 256).to_pylist()]
                hashes, bounds = shingle_sets(texts, size)
                counts = np.diff(bounds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, counts)), pa.array(hashes.view(np.int64)),
                     pa.array(np.repeat(counts, counts))], names=["id", "key", "size"])

    own = write_shared(blobs.join(ids, "id", "left_semi").mapInArrow(sets, "id bigint, key bigint, size bigint"), "shingles")
    common = write_shared(own.groupBy("key").agg(F.count("*").alias("df")).where("df > 1"), "common-shingles")
    shared = spread_join(own, common, ["key"], common.select("key", F.col("df").alias("load")), ["id"])
    listed = shared.groupBy("id").agg(F.first("size").alias("size"),
                                      F.sort_array(F.collect_list(F.struct("df", "key"))).alias("shared"))
    places = F.expr(f"size - (size * {percent} + 99) div 100 + 1 - (size - size(shared))")
    prefix = F.slice("shared", 1, F.greatest(F.lit(0), places).cast("int"))
    return (listed.select("id", "size", F.size("shared").alias("n"), F.posexplode(prefix).alias("at", "s"))
            .select(F.col("s.key").alias("key"), "id", "size", (F.col("n") - F.col("at")).alias("rest")))


def text_of_members(docs: DataFrame, members: DataFrame) -> DataFrame:
    """``(id, blob)``: the compressed texts of the ids that share a table with another."""
    ids = members.select("id").distinct()
    if ids.count() * ROW_BYTES <= BROADCAST_BYTES:
        ids = F.broadcast(ids)
    texts = docs.join(ids, "id", "left_semi").select("id", squeezed()("text").alias("f"))
    return texts.select("id", "f.blob").dropDuplicates(["id"])


class Search:
    """The state of a search for links: what has been tried, and the groups that links have made so far."""

    def __init__(self, blobs: DataFrame, size: int, percent: int, pairs: DataFrame):
        self.blobs, self.size, self.percent = blobs, size, percent
        self.tried = write_shared(pairs, "pairs")
        self.labels = components(linked(self.tried, blobs, size, percent))

    def try_pairs(self, pairs: DataFrame) -> bool:
        """Try those of the pairs that have not been tried; whether any link was new."""
        pairs = write_shared(pairs.join(self.tried, ["a", "b"], "left_anti"), "pairs")
        if pairs.isEmpty():
            return False
        self.tried = self.tried.union(pairs)
        links = write_shared(linked(pairs, self.blobs, self.size, self.percent), "links")
        if links.isEmpty():
            return False
        known = self.labels.select(F.col("id").alias("a"), F.col("component").alias("b"))
        self.labels = components(known.union(links))
        return True

    def open_ids(self, members: DataFrame) -> DataFrame:
        """Ids in tables of more than two members that hold several groups: there pairs may be untried."""
        rows, mixed = grouped_by(self.labels, members)
        return rows.join(mixed.where("n > 2").select("key"), "key", "left_semi").select("id").distinct()


def several_texts(docs: DataFrame, members: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """Where an id has texts with different sets: ``docs`` and ``classes`` in which each class has an id of its own,
    and ``links (a, b)`` between the classes of one id. None where no id has.

    Of the classes that begin with one id, one keeps it and the others get numbers above all ids. As each is linked
    with the class that has the id, no such number is the least of a component.
    """
    twice = members.groupBy("id").agg(F.min("digest").alias("least"), F.max("digest").alias("most")).where("least < most")
    twice = write_shared(twice.select("id"), "repeated-ids")
    if twice.isEmpty():
        return None
    top = docs.agg(F.max("id").alias("top")).first()["top"]
    first = classes.groupBy("id").agg(F.min("digest").alias("first"))
    numbered = (lookup_join(classes, first, "id", ["digest"]).withColumn("doc", F.col("id"))
                .withColumn("id", F.when(F.col("digest") == F.col("first"), F.col("id"))
                            .otherwise(F.lit(top) + 1 + F.monotonically_increasing_id())).drop("first"))
    numbered = write_shared(numbered, "classes")
    own = lookup_join(members.join(twice, "id", "left_semi").select("id", "digest").distinct(),
                      numbered.select("digest", F.col("id").alias("class")), "digest", ["id"])
    links = (lookup_join(own, own.groupBy("id").agg(F.min("class").alias("a")), "id", ["class"])
             .where("a < class").select("a", F.col("class").alias("b")))
    named = (numbered.select("doc", "text_key", F.col("id").alias("class"))
             .join(twice.withColumnRenamed("id", "doc"), "doc", "left_semi"))
    keyed = docs.withColumn("text_key", F.xxhash64("text")).withColumnRenamed("id", "doc")
    theirs = keyed.join(named, ["doc", "text_key"]).select(F.col("class").alias("id"), "text")
    return docs.join(twice, "id", "left_anti").unionByName(theirs), numbered.drop("doc"), write_shared(links, "same-ids")


def class_components(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame | None:
    """``(id, component)`` of the classes that verified links connect; None if no two meet in a table.

    Each table links its members to its least one. For a few rounds, groups of connected
    classes that still meet in a table are then linked by one pair each. That leaves pairs
    untried in tables where classes meet that are not connected, as those that share a
    passage do. There all pairs would be too many. Instead the classes of such tables are
    brought together anew by their rarest shingles, of which similar ones share one for
    certain, and all pairs of groups that meet there and can be similar are tried. So no link is lost that
    any table has, and none of a frequent passage's pairs are made.
    """
    keys = tables(classes)
    shared = write_shared(keys.groupBy("key").agg(F.min("id").alias("pivot"), F.count("*").alias("load"))
                          .where("load > 1"), "tables")
    members = write_shared(spread_join(keys, shared.select("key", "pivot"), ["key"], shared.select("key", "load"),
                                       ["id"]), "members")
    if members.isEmpty():
        return None
    blobs = write_shared(text_of_members(docs, members), "member-texts")
    search = Search(blobs, size, percent,
                    members.where("id > pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct())
    members = members.select("key", "id")
    for _ in range(STAR_ROUNDS):
        if not search.try_pairs(pairs_of_groups(members, search.labels)):
            break
    left = write_shared(search.open_ids(members), "open")
    if left.isEmpty():
        return search.labels
    rare = write_shared(rare_shingles(blobs, left, size, percent), "rare-shingles")
    for _ in range(STAR_ROUNDS):
        if not search.try_pairs(pairs_of_groups(rare.select("key", "id"), search.labels)):
            break
    search.try_pairs(all_pairs(rare, search.labels, percent))
    return search.labels


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_shingles, component_id, kept)``, one row per row of ``docs``.

    Two documents are linked if the sets of their distinct shingles, ``shingle_words`` words
    each, have ``100 * common >= percent * union``. Words end at ASCII white space, with A-Z
    lower-cased. ``component_id`` is the least id reachable over links, ``kept`` whether it is
    the document's own.

    Documents with equal sets are one class, so copies cost nothing further. Candidates
    come from tensored tables whose keys join one half from each of two collections of minimum
    hashes. With ``n`` halves per collection there are ``n * n`` tables from ``2 * n``
    halves. Every link is confirmed on full sets. A pair at the threshold is not met
    in any table with a chance of ``MISS``, and less above it.

    Null, empty and blank texts have no shingles and are linked with nothing. A text shorter than
    a shingle has its word sequence as its only one. Whole texts are used. Rows repeated with
    their id are one document and get the same result. Rows of one id with different texts are one document too, which is
    linked with all that any of its texts is linked with. Rows without an id are linked with
    nothing, have no component and are kept. Other columns are ignored; an empty table gives
    an empty result.
    """
    halves = halves_needed(percent)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    found = write_shared(rows.select("id", F.xxhash64("text").alias("text_key"),
                                     signatures(shingle_words, halves, HALF)("text").alias("f"))
                         .select("id", "text_key", "f.*"), "signatures")
    members = found.where("n_shingles > 0 and id is not null")
    classes = write_shared(
        members.groupBy("digest").agg(F.min(F.struct("id", "text_key", "left", "right")).alias("s")).select("digest", "s.*"),
        "classes")
    texts, same = rows, None
    repeated = several_texts(rows, members, classes)
    if repeated is not None:
        texts, classes, same = repeated
    connected = class_components(texts, classes, shingle_words, percent)
    if same is not None:
        known = same.limit(0) if connected is None else connected.select(F.col("id").alias("a"), F.col("component").alias("b"))
        connected = components(known.unionByName(same))
    label = classes.select("digest", "id")
    if connected is None:
        label = label.withColumnRenamed("id", "component_id")
    else:
        label = (label.join(connected, "id", "left")
                 .select("digest", F.coalesce("component", "id").alias("component_id")))
    keyed = found.withColumn("digest", F.when((F.col("n_shingles") > 0) & F.col("id").isNotNull(), F.col("digest")))
    single = keyed.where("digest is null").select("id", "n_shingles", F.col("id").alias("component_id"))
    joined = lookup_join(keyed.where("digest is not null"), label, "digest", ["id"]).select(
        "id", "n_shingles", "component_id")
    out = joined.union(single).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))
    return out.select(F.col("id").cast(id_type).alias(id_col), "n_shingles",
                      F.col("component_id").cast(id_type).alias("component_id"), "kept")


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all columns; those without an id stay."""
    found = write_shared(near_duplicates(docs, id_col=id_col, text_col=text_col, **kw), "near-duplicates")
    dropped = found.where(~F.col("kept")).select(id_col).distinct()
    if dropped.count() * ROW_BYTES <= BROADCAST_BYTES:
        dropped = F.broadcast(dropped)
    return docs.join(dropped, id_col, "left_anti").select(*docs.columns)


def op10_near_duplicates(spark, sf_dir):
    """Shingles of three words, at least 85 per cent in common."""
    return near_duplicates(read(spark, sf_dir, "documents"), shingle_words=3, percent=85)
