"""Packing of tokenised documents into sequences of bounded length."""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import arrow_slices, read
from trawl.llm.tokens import vocabulary, word_tokenizer

WINDOW = 4096
#: Id put after each document.
END_ID = 2
#: Costs, in tokens of padding, of a cut after a sentence and of a cut elsewhere in a document.
SENTENCE_CUT, TOKEN_CUT = 8, 32
#: A stretch without sentence ends gets a possible cut every so many tokens.
STRIDE = 128
#: Tokens over which cuts are chosen together.
SEGMENT = 1_000_000


def possible_cuts(ids: np.ndarray, doc_ends: np.ndarray, stops: np.ndarray, window: int,
                  last: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which the stream may be cut, 0 and its end included, and the cost of each.

    At the end of the stream all positions of the last window are possible: there the rest
    may be cut into sequences whose lengths are powers of two.
    """
    cost = np.full(len(ids) + 1, -1, np.int64)
    stride = min(STRIDE, window)
    ends = np.flatnonzero(stops[ids]) + 1
    cost[ends] = SENTENCE_CUT
    cost[doc_ends] = 0
    cost[0] = cost[-1] = 0
    known = np.flatnonzero(cost >= 0)
    for at in np.flatnonzero(np.diff(known) > stride):
        cost[known[at] + stride:known[at + 1]:stride] = TOKEN_CUT
    if last:
        tail = cost[-window - 1:]
        tail[tail < 0] = TOKEN_CUT
    where = np.flatnonzero(cost >= 0)
    return where, cost[where]


def choose_cuts(where: list[int], cost: list[int], window: int, exact_from: int) -> list[int]:
    """Cuts with the least padding and cut costs in total, in order, from 0 to the end.

    A sequence of length n costs its padding, ``window - n``, or nothing if n is a power of
    two. With ``best[i]`` the least cost up to cut i,
    ``best[j] = cost[j] + window - where[j] + min(best[i] + where[i])`` over the cuts i at most
    ``window`` before j. The minimum is the head of a queue whose values rise. Lengths that
    are powers of two are tried besides from position ``exact_from`` on.
    """
    best, came = [0], [0]
    queue = deque([(where[0], 0)])
    index = {where[0]: 0}
    powers = [1 << k for k in range(window.bit_length()) if 1 << k <= window]
    for j in range(1, len(where)):
        at = where[j]
        while where[queue[0][1]] < at - window:
            queue.popleft()
        value, i = queue[0]
        value += window - at
        if at >= exact_from:
            index[at] = j
            for length in powers:
                k = index.get(at - length)
                if k is not None and best[k] < value:
                    value, i = best[k], k
        value += cost[j]
        best.append(value)
        came.append(i)
        value += at
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    cuts, j = [where[-1]], len(where) - 1
    while j:
        j = came[j]
        cuts.append(where[j])
    return cuts[::-1]


class Stream:
    """Tokens of consecutive documents that have not been put into sequences yet."""

    def __init__(self, window: int, stops: np.ndarray, first_sequence: int):
        self.window, self.stops, self.sequence = window, stops, first_sequence
        self.parts: list[np.ndarray] = []
        self.docs: list[tuple] = []  # id, number of tokens, tokens placed already
        self.size = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.parts.append(ids)
        self.docs.append((doc_id, len(ids), 0))
        self.size += len(ids)

    def place(self, last: bool) -> list[list]:
        """Columns of the pieces in sequences that are settled: all, or all but the last two."""
        ids = np.concatenate(self.parts) if len(self.parts) > 1 else self.parts[0]
        left = np.array([n - done for _, n, done in self.docs])
        doc_ends = np.cumsum(left)
        where, cost = possible_cuts(ids, doc_ends, self.stops, self.window, last)
        exact_from = max(0, len(ids) - 2 * self.window) if last else len(ids) + 1
        cuts = choose_cuts(where.tolist(), cost.tolist(), self.window, exact_from)
        if not last:
            cuts = cuts[:-2]
        upto = cuts[-1]
        bounds = np.unique(np.concatenate((cuts, doc_ends[doc_ends < upto])))
        begins, ends = bounds[:-1], bounds[1:]
        doc = np.searchsorted(doc_ends, begins, "right")
        sequence = np.searchsorted(cuts, begins, "right") - 1
        done = np.array([d for _, _, d in self.docs])
        data = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
        pieces = [
            [self.docs[d][0] for d in doc.tolist()],
            begins - (doc_ends - left)[doc] + done[doc],
            ends - begins,
            [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(begins.tolist(), ends.tolist())],
            [self.docs[d][1] for d in doc.tolist()],
            self.sequence + sequence,
            begins - np.asarray(cuts)[sequence]]
        self.sequence += len(cuts) - 1
        first = int(np.searchsorted(doc_ends, upto, "right"))
        kept = self.docs[first:]
        if kept:
            doc_id, n, before = kept[0]
            kept[0] = (doc_id, n, before + upto - int(doc_ends[first] - left[first]))
        self.docs, self.parts, self.size = kept, [ids[upto:].copy()], len(ids) - upto
        return pieces


def pack(docs: DataFrame, tokenizer_path: str | None = None, window: int = WINDOW,
         id_col: str = "doc_id", text_col: str = "text", segment: int = SEGMENT) -> DataFrame:
    """``(id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``, one row per piece.

    A document is its token ids and then ``END_ID``. The documents of a partition, in their
    order, make one stream. It is cut into sequences of at most ``window`` ids at ends of
    documents, ends of sentences or, in stretches without those, every ``STRIDE`` ids. The
    cuts minimise padding plus the costs of cuts inside documents, over segments of about
    ``segment`` ids; the last two sequences of a segment are chosen anew with the next one.
    Every partition packs its own rows, so nothing is exchanged, and what is held in memory
    does not depend on its size. The rest of a partition may go to sequences whose lengths
    are powers of two, which need no padding.

    A null or empty text is one id, ``END_ID``. A text of any length is packed whole. Repeated
    rows are packed once each, null ids stay null. An empty table gives an empty result. Other
    columns are ignored.
    """
    path = tokenizer_path or vocabulary()
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
              "sequence_id bigint, offset bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path)
        stream = Stream(window, tokenizer.stops, TaskContext.get().partitionId() << 33)
        id_arrow = None

        def placed(last: bool) -> pa.RecordBatch:
            columns = stream.place(last)
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], id_arrow), *(pa.array(c, pa.int64()) for c in columns[1:])],
                names=[id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            id_arrow, keys, at = batch.schema.field(0).type, batch.column(0), 0
            for texts in arrow_slices(batch.column(1)):
                for key, data in zip(keys.slice(at, len(texts)).to_pylist(), tokenizer.ids(texts)):
                    stream.add(key, np.append(np.frombuffer(data, "<u4"), np.uint32(END_ID)))
                at += len(texts)
                if stream.size >= segment:
                    yield placed(False)
        if stream.size:
            yield placed(True)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def op5_packing(spark, sf_dir):
    return pack(read(spark, sf_dir, "documents"))
