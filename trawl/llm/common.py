"""What the operators share: tables, text functions over Arrow batches, word hashing."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Characters of text that one call of a text function works on; a longer text comes alone.
SLICE_CHARS = 2_000_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; null for a null key."""
    return F.crc32(F.col(key).cast("string")) % modulus


def slices(texts: Iterable[str | None], chars: int = SLICE_CHARS) -> Iterator[list[str]]:
    """Consecutive texts of ``chars`` characters or little more in total; null becomes empty."""
    part, held = [], 0
    for text in texts:
        part.append(text or "")
        held += len(part[-1])
        if held >= chars:
            yield part
            part, held = [], 0
    if part:
        yield part


def text_function(compute: Callable[[list[str]], list], schema: str, names: list[str],
                  types: list[pa.DataType], chars: int = SLICE_CHARS):
    """A function of a text column that returns a struct, run on bounded slices of Arrow batches.

    ``compute`` gets a list of texts and returns one sequence of values per field.
    Rows keep their other columns in the JVM.
    """
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            done = []
            for part in arrow_slices(batch, chars):
                fields = [pa.array(v, t) for v, t in zip(compute(part), types, strict=True)]
                done.append(pa.StructArray.from_arrays(fields, names=names))
            if done:
                yield pa.concat_arrays(done)
            else:
                yield pa.StructArray.from_arrays([pa.array([], t) for t in types], names=names)
    return F.arrow_udf(run, schema)


def arrow_slices(batch: pa.Array, chars: int = SLICE_CHARS, rows: int = 256) -> Iterator[list[str]]:
    """``slices`` of a string array that turns only a few rows at a time into Python strings."""
    def values():
        for at in range(0, len(batch), rows):
            yield from batch.slice(at, rows).to_pylist()
    return slices(values(), chars)


# --- words as arrays of bytes ---------------------------------------------------------------

ODD = np.uint64(0x9E3779B97F4A7C15)
POWERS = np.array([0x100000001B3], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of a fixed odd base modulo 2^64; the table grows with the longest word."""
    global POWERS
    if len(POWERS) < n:
        POWERS = np.multiply.accumulate(np.full(max(n, 64), 0x100000001B3, np.uint64))
    return POWERS[:n]


class Words:
    """The words of texts as arrays: text number, first and last byte, 64-bit hash.

    ``inside`` is a table of 256 flags for the bytes that belong to words.
    """

    def __init__(self, texts: list[bytes], inside: np.ndarray):
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.buffer = b"\n".join(texts) + b"\n"
        self.bytes = np.frombuffer(self.buffer, np.uint8)
        flags = inside[self.bytes]
        edges = np.flatnonzero(flags[1:] != flags[:-1]) + 1
        if len(flags) and flags[0]:
            edges = np.concatenate(([0], edges))
        self.starts, self.ends = edges[0::2], edges[1::2]
        text_ends = np.cumsum(self.lengths + 1)
        self.text = np.searchsorted(text_ends, self.starts, "right")
        self.counts = np.bincount(self.text, minlength=len(texts))
        self.firsts = np.concatenate(([0], np.cumsum(self.counts)))
        self.hashes = self._hash(flags)

    def _hash(self, flags: np.ndarray) -> np.ndarray:
        sizes = self.ends - self.starts
        if not len(sizes):
            return np.zeros(0, np.uint64)
        offsets = np.cumsum(sizes) - sizes
        place = np.arange(offsets[-1] + sizes[-1]) - np.repeat(offsets, sizes)
        terms = powers(int(sizes.max()))[place] * (self.bytes[flags].astype(np.uint64) + np.uint64(1))
        return mix(np.add.reduceat(terms, offsets) + sizes.astype(np.uint64) * ODD)

    def beginnings(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Words of ``size`` bytes or more, and the hash of so many of their first bytes."""
        which = np.flatnonzero(self.ends - self.starts >= size)
        total = np.full(len(which), size, np.uint64)
        for n, power in enumerate(powers(size)):
            total += power * (self.bytes[self.starts[which] + n].astype(np.uint64) + np.uint64(1))
        return which, mix(total * ODD)


def byte_flags(chars: bytes) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[np.frombuffer(chars, np.uint8)] = True
    return flags


#: Bytes of words that end at ASCII white space.
UNSPACED = ~byte_flags(b" \t\n\r\x0b\x0c")
#: Lower-case ASCII letters, digits and every byte of other scripts.
ALPHANUMERIC = byte_flags(b"abcdefghijklmnopqrstuvwxyz0123456789" + bytes(range(128, 256)))


def ascii_lower(text: str) -> bytes:
    """UTF-8 bytes with A-Z lower-cased and nothing else changed."""
    return text.encode().lower()
