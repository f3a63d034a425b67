"""Removal of word windows that occur earlier in the corpus, by super-k-mer partitioning."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import ODD, UNSPACED, Words, arrow_slices, mix, read

WINDOW = 20
#: Words of the pieces whose least hash decides where a window goes.
PIECE = 3
#: Of the packed strings, which are most of what is exchanged.
COMPRESSION = 6
#: Characters of text whose windows one bucket holds, about.
BUCKET_CHARS = 8_000_000
#: Characters turned into arrays together, and held until packed strings are sent.
STEP_CHARS, PACK_CHARS = 500_000, 8_000_000
#: Windows of one least hash that are too many for a bucket, unless that made more than so many such hashes; and the
#: share of the documents by which they are counted. They decide where windows go, not what is found.
FREQUENT_WINDOWS, MOST_FREQUENT, COUNTED_ONE_IN = 200_000, 100_000, 64
NOTHING, LATE = np.zeros(0, np.uint64), np.uint64(1 << 63)
#: Stands for a null id, after all others.
NO_ID = np.iinfo(np.int64).max


def rolled(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive hashes, by doubling: position i covers i to i + size - 1."""
    total, done, part, width = None, 0, hashes, 1
    while True:
        if size & width:
            if total is None:
                total, done = part, width
            else:
                n = len(part) - done
                total = total[:n] + part[done:] * pow_odd(done)
                done += width
        width *= 2
        if width > size:
            return mix(total[:len(hashes) - size + 1])
        part = part[:-(width // 2)] + part[width // 2:] * pow_odd(width // 2)


def pow_odd(n: int) -> np.uint64:
    return np.uint64(pow(int(ODD), n, 1 << 64))


def sliding_least(x: np.ndarray, size: int) -> np.ndarray:
    least, width = x, 1
    while width < size:
        step = min(width, size - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    return least


def super_kmers(words: Words, window: int = WINDOW, piece: int = PIECE,
                frequent: np.ndarray = NOTHING) -> tuple[np.ndarray, ...]:
    """First word, number of windows and least hash of each run of windows that share the least hash.

    The hash of a window is the least over its pieces of ``piece`` words. Windows lie within one
    text. Pieces whose hashes are among the sorted ``frequent`` ones count only after all others, and a window of nothing
    else has the hash of all its words. So a window's hash still follows from its words alone.
    """
    n = len(words.starts) - window + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    pieces = rolled(words.hashes, piece) >> np.uint64(1)
    if len(frequent):
        near = frequent[np.minimum(np.searchsorted(frequent, pieces), len(frequent) - 1)]
        pieces = np.where(near == pieces, pieces | LATE, pieces)
    least = sliding_least(pieces, window - piece + 1)
    if len(frequent):
        least = np.where(least >= LATE, rolled(words.hashes, window), least)
    at = np.flatnonzero(words.text[:n] == words.text[window - 1:])
    least = least[at]
    new = np.append(True, (np.diff(at) != 1) | (least[1:] != least[:-1])) if len(at) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return at[first], np.diff(np.append(first, len(at))), least[first]


class Packer:
    """Packed strings of a part of the corpus, each distinct one once, by bucket.

    Of equal strings only the earliest travels. The windows of the others are known to
    occur earlier, so only their ranges are sent.
    """

    def __init__(self, buckets: int, window: int, piece: int, frequent: np.ndarray = NOTHING):
        self.buckets, self.window, self.piece, self.frequent = buckets, window, piece, frequent
        self.clear()

    def clear(self) -> None:
        self.strings: dict[bytes, list] = {}
        self.repeated: list[tuple] = []
        self.chars = 0

    def add(self, keys: list[int], texts: list[str]) -> None:
        raw = [t.encode() for t in texts]
        sums = [zlib.crc32(r) for r in raw]
        words = Words([b" ".join(r.split()) for r in raw], UNSPACED)
        first, count, least = super_kmers(words, self.window, self.piece, self.frequent)
        last = first + count + self.window - 2
        text = words.text[first]
        held, window, buffer = self.strings, self.window, words.buffer
        for a, b, t, start, n, bucket in zip(
                words.starts[first].tolist(), words.ends[last].tolist(), text.tolist(),
                (first - words.firsts[text]).tolist(), count.tolist(),
                (least % np.uint64(self.buckets)).tolist()):
            string, own = buffer[a:b], [keys[t], start, sums[t], n, bucket]
            before = held.setdefault(string, own)
            if before is own or before[:2] == own[:2]:
                continue
            if own < before:
                held[string], own = own, before
            self.repeated.append((bucket, own[0], own[2], own[1], own[1] + own[3] + window - 1))
        self.chars += len(words.buffer)

    def packed(self) -> Iterator[tuple[int, bytes]]:
        """A bucket and its strings, with ids, checksums and places, compressed."""
        where = np.array([v[4] for v in self.strings.values()], np.int64)
        order = np.argsort(where, kind="stable")
        strings, values = list(self.strings), list(self.strings.values())
        ranges = np.array(self.repeated, np.int64).reshape(-1, 5)
        ranges = ranges[np.argsort(ranges[:, 0], kind="stable")]
        squeeze = zstandard.ZstdCompressor(level=COMPRESSION)
        for bucket in np.union1d(where, ranges[:, 0]).tolist():
            a, b = np.searchsorted(where[order], [bucket, bucket + 1])
            own = order[a:b].tolist()
            c, d = np.searchsorted(ranges[:, 0], [bucket, bucket + 1])
            numbers = np.array([values[i][:3] for i in own], np.int64).reshape(-1, 3)
            data = b"".join([np.array([len(own), d - c], np.int64).tobytes(), numbers.T.tobytes(),
                             ranges[c:d, 1:].T.tobytes(), b"\n".join(strings[i] for i in own)])
            yield bucket, squeeze.compress(data)
        self.clear()


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n, m = np.frombuffer(data, np.int64, 2).tolist()
    numbers = np.frombuffer(data, np.int64, 3 * n, 16).reshape(3, n)
    ranges = np.frombuffer(data, np.int64, 4 * m, 16 + 24 * n).reshape(4, m)
    return numbers, ranges, data[16 + 24 * n + 32 * m:].split(b"\n") if n else []


def repeated_windows(blobs: list[bytes], window: int = WINDOW) -> np.ndarray:
    """Rows ``(id, checksum, first word, end)``: ranges of words in windows that occur earlier, of one bucket.

    All windows are sorted by a hash of their words, and those with equal hashes are compared
    as strings, so the result is exact.
    """
    ranges, ids, sums, places, hashes, strings, begins, ends = ([] for _ in range(8))
    held = 0
    for blob in blobs:
        numbers, known, own = unpacked(blob)
        ranges.append(known.T)
        step = max(1, STEP_CHARS // 200)
        for at in range(0, len(own), step):
            part = own[at:at + step]
            words = Words(part, UNSPACED)
            n = len(words.starts) - window + 1
            first = np.flatnonzero(words.text[:n] == words.text[window - 1:])
            text = words.text[first]
            ids.append(numbers[0, at + text])
            sums.append(numbers[2, at + text])
            places.append(numbers[1, at + text] + first - words.firsts[text])
            hashes.append(rolled(words.hashes, window)[first])
            strings.append(words.buffer)
            begins.append(words.starts[first] + held)
            ends.append(words.ends[first + window - 1] + held)
            held += len(words.buffer)
    if hashes:
        own, crc, place, key, a, b = map(np.concatenate, (ids, sums, places, hashes, begins, ends))
        text = b"".join(strings)
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = order[np.append(same, False) | np.append(False, same)]
        twice = twice[np.lexsort((place[twice], own[twice], key[twice]))]
        later = later_windows(text, key[twice], own[twice], place[twice], a[twice], b[twice])
        hit = twice[later]
        ranges.append(np.stack([own[hit], crc[hit], place[hit], place[hit] + window], axis=1))
    return joined_ranges(np.concatenate(ranges)) if ranges else np.zeros((0, 4), np.int64)


def later_windows(text: bytes, key, own, place, a, b) -> np.ndarray:
    """Places in the sorted windows of those that equal an earlier one; ``text[a:b]`` is a window's words."""
    later: list[int] = []
    first: dict[bytes, tuple] = {}
    last_key = None
    for n, (k, i, p, x, y) in enumerate(zip(key.tolist(), own.tolist(), place.tolist(), a.tolist(), b.tolist())):
        if k != last_key:
            first, last_key = {}, k
        string = text[x:y]
        known = first.setdefault(string, (i, p))
        if known < (i, p):
            later.append(n)
    return np.array(later, np.int64)


def joined_ranges(rows: np.ndarray) -> np.ndarray:
    """Ranges of one text that touch or overlap made one."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    group = np.cumsum(np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(1))) - 1
    # Ends rise within a text's ranges once the largest so far is taken; a step per text keeps texts apart.
    step = int(rows[:, 3].max()) + 1
    reach = np.maximum.accumulate(rows[:, 3] + group * step)
    new = np.append(True, rows[1:, 2] + group[1:] * step > reach[:-1])
    first = np.flatnonzero(new)
    out = rows[first].copy()
    out[:, 3] = reach[np.append(first[1:] - 1, len(rows) - 1)] - group[first] * step
    return out


RANGES = "id bigint, crc bigint, start bigint, stop bigint"


def frequent_pieces(docs: DataFrame, size: int, window: int, piece: int, windows: int = FREQUENT_WINDOWS,
                    one_in: int = COUNTED_ONE_IN) -> np.ndarray:
    """Least hashes of more than ``windows`` windows, about, in order.

    A short line that stands in very many documents between ever different words would fill one bucket. Windows are counted
    in one document of ``one_in``, chosen by a hash of the text. At most ``MOST_FREQUENT`` hashes are returned, as the
    number that counts as too many rises with the text.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in arrow_slices(batch.column(0), STEP_CHARS, 64):
                words = Words([b" ".join(t.encode().split()) for t in texts], UNSPACED)
                _, n, least = super_kmers(words, window, piece)
                hashes, which = np.unique(least, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes.view(np.int64)), pa.array(np.bincount(which, n, len(hashes)).astype(np.int64))],
                    names=["least", "n"])
    # A window takes two bytes of text or more.
    cut = max(windows, size // (2 * MOST_FREQUENT)) / one_in
    counted = (docs.where(F.pmod(F.xxhash64("text"), F.lit(one_in)) == 0).select("text")
               .mapInArrow(count, "least bigint, n bigint").groupBy("least").agg(F.sum("n").alias("n")))
    found = counted.where(F.col("n") > cut).orderBy(F.desc("n"), "least").limit(MOST_FREQUENT).collect()
    return np.sort(np.array([r["least"] for r in found], np.int64).view(np.uint64))


def repeated_ranges(docs: DataFrame, window: int = WINDOW, piece: int = PIECE, bucket_chars: int = BUCKET_CHARS,
                    frequent_windows: int = FREQUENT_WINDOWS, one_in: int = COUNTED_ONE_IN) -> DataFrame:
    """``(id, crc, start, stop)``: ranges of words in windows that start earlier elsewhere, of ``docs (id, text)``."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = size // bucket_chars + 1
    frequent = frequent_pieces(docs, size, window, piece, frequent_windows, one_in)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(buckets, window, piece, frequent)

        def sent() -> pa.RecordBatch:
            rows = list(packer.packed())
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
                names=["bucket", "blob"])
        for batch in batches:
            keys, at = batch.column(0).fill_null(NO_ID), 0
            for texts in arrow_slices(batch.column(1), STEP_CHARS, 64):
                packer.add(keys.slice(at, len(texts)).to_pylist(), texts)
                at += len(texts)
                if packer.chars >= PACK_CHARS:
                    yield sent()
        if packer.chars:
            yield sent()

    def sort(table: pa.Table) -> pa.Table:
        rows = repeated_windows(table.column("blob").to_pylist(), window)
        ids = pa.array(rows[:, 0], pa.int64(), mask=rows[:, 0] == NO_ID)
        return pa.table([ids, *(pa.array(rows[:, n], pa.int64()) for n in (1, 2, 3))],
                        names=["id", "crc", "start", "stop"])

    packed = docs.select("id", "text").mapInArrow(pack, "bucket bigint, blob binary")
    return packed.groupBy("bucket").applyInArrow(sort, RANGES)


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                   piece: int = PIECE, bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """``(id, n_words, n_removed, kept)``: each text without the words of windows that start earlier elsewhere.

    A window is ``window`` consecutive words of one document, and words end at ASCII white
    space. Of equal windows the one with the smallest id, then the smallest start, stays; every
    word in any other is removed. ``kept`` joins the words that stay by one space.

    Null and empty texts have no words, and texts shorter than a window keep all. Texts are
    judged whole. Rows repeated with their id and text are one document: each keeps what
    the other keeps. Rows of one id with different texts are one document for the order of
    windows. Documents without an id come after all others and count as one. Other columns
    are ignored; an empty table gives an empty result.

    Runs of windows with the same least hash travel as one compressed string to the bucket of
    that hash, so a word is sent about three times. Equal strings within a part of the corpus
    travel once, so a passage in very many documents does not fill a bucket. Nor does a short line between ever
    different words: windows with it go by their other words. The number of buckets grows with the text.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    ranges = (repeated_ranges(rows, window, piece, bucket_chars).groupBy("id", "crc")
              .agg(F.collect_list(F.struct("start", "stop")).alias("ranges")))

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in arrow_slices(batch.column(1), 2_000_000, 64):
                found = [without(t, r) for t, r in zip(texts, batch.column(2).slice(at, len(texts)).to_pylist())]
                columns = list(zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(columns[0], pa.int64()),
                     pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
                    names=["id", "n_words", "n_removed", "kept"])
                at += len(texts)

    text = rows.withColumn("crc", F.crc32(F.coalesce("text", F.lit("")))).alias("t")
    marked = text.join(ranges.alias("r"), F.col("t.id").eqNullSafe(F.col("r.id"))
                       & (F.col("t.crc") == F.col("r.crc")), "left")
    stripped = marked.select("t.id", "t.text", "r.ranges").mapInArrow(
        strip, "id bigint, n_words bigint, n_removed bigint, kept string")
    return stripped.withColumn("id", F.col("id").cast(id_type)).withColumnRenamed("id", id_col)


def without(text: str, ranges: list[dict] | None) -> tuple[int, int, str]:
    words = text.encode().split()
    if not ranges:
        return len(words), 0, b" ".join(words).decode()
    keep = np.ones(len(words), bool)
    for r in ranges:
        keep[r["start"]:r["stop"]] = False
    kept = [w for w, k in zip(words, keep.tolist()) if k]
    return len(words), len(words) - len(kept), b" ".join(kept).decode()


def op6_substring_dedup(spark, sf_dir):
    found = remove_repeats(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
