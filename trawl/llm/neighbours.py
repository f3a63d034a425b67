"""Nearest neighbours by cosine: a block matrix join on quantised vectors with proven error bounds."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.common import read

#: Bytes of query vectors in one block; a block goes to every executor.
BLOCK_BYTES = 32_000_000
#: Candidates and queries in one product.
TILE_ROWS, TILE_QUERIES = 4096, 512
LEVELS = 127


def usable(ids: pa.Array, vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors by number of components, without those that take no part."""
    lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    whole = vectors.is_valid().to_numpy(zero_copy_only=False) & ids.is_valid().to_numpy(zero_copy_only=False)
    for size in np.unique(lengths[whole & (lengths > 0)]):
        own = pa.array(np.flatnonzero(whole & (lengths == size)))
        flat = vectors.take(own).flatten().cast(pa.float64())
        x = flat.to_numpy(zero_copy_only=False).reshape(-1, size)  # a null component becomes NaN
        keys = ids.take(own).to_numpy(zero_copy_only=False)
        with np.errstate(over="ignore", invalid="ignore"):
            good = np.isfinite(x).all(1) & (np.abs(x).max(1) > 0)
        if good.any():
            yield keys[good], np.ascontiguousarray(x[good])


class Quantised:
    """Vectors as whole numbers from -127 to 127 with a scale each, and the norm of what that leaves out.

    With ``u = scale * q + e`` for the vector of length 1, the product of two vectors differs
    from that of their quantised forms by at most ``|e| * |scale' * q'| + |e'|``.
    """

    def __init__(self, x: np.ndarray):
        self.x = x
        big = np.abs(x).max(1, keepdims=True)
        self.norm = big[:, 0] * np.sqrt(((x / big) ** 2).sum(1))
        unit = x / big
        unit /= np.sqrt((unit ** 2).sum(1, keepdims=True))
        self.scale = np.abs(unit).max(1) / LEVELS
        self.q = np.rint(unit / self.scale[:, None]).astype(np.int8)
        near = self.q * self.scale[:, None]
        self.near_norm = np.sqrt((near ** 2).sum(1))
        self.error = np.sqrt(((unit - near) ** 2).sum(1))

    def bounds(self, queries: slice, other: Quantised, rows: slice) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible cosine of each query with each row of ``other``.

        Products of 8-bit numbers are whole and below 2^24 for vectors of up to 1,040 components,
        so a product in single precision is exact; beyond that it is made in double precision.
        """
        kind = np.float32 if self.q.shape[1] * LEVELS * LEVELS < 1 << 24 else np.float64
        product = (self.q[queries].astype(kind) @ other.q[rows].astype(kind).T).astype(np.float64)
        about = product * self.scale[queries][:, None] * other.scale[rows][None, :]
        off = (self.error[queries][:, None] * other.near_norm[rows][None, :] + other.error[rows][None, :] + 1e-12)
        return about - off, about + off

    def cosine(self, queries: np.ndarray, other: Quantised, rows: np.ndarray) -> np.ndarray:
        """Of pairs, in double precision from the original vectors, scaled so that no square overflows."""
        a, b = self.x[queries], other.x[rows]
        a = a / np.abs(a).max(1, keepdims=True)
        b = b / np.abs(b).max(1, keepdims=True)
        return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def fewest_copies(keys: np.ndarray, x: np.ndarray, copies: int) -> np.ndarray:
    """Rows in order of the id without repeated rows and with the first ``copies`` of equal vectors only.

    Of equal vectors no more than that can be among the nearest of any query.
    """
    order = np.argsort(keys, kind="stable")
    x = np.ascontiguousarray(x[order] + 0.0)  # no negative zeros
    _, kind = np.unique(x.view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel(), return_inverse=True)
    by_kind = np.lexsort((np.arange(len(kind)), kind))
    group, key = kind[by_kind], keys[order][by_kind]
    first = np.append(True, np.diff(group) != 0)
    new = np.append(True, (np.diff(group) != 0) | (key[1:] != key[:-1]))
    count = np.cumsum(new)
    rank = count - count[np.maximum.accumulate(np.where(first, np.arange(len(group)), 0))]
    return np.sort(order[by_kind[new & (rank < copies)]])


def best_of_each(keys: np.ndarray, least: np.ndarray) -> np.ndarray:
    """The columns' largest bound of each id, as rows of one id are one candidate."""
    order = np.argsort(keys, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(keys[order]) != 0))
    return least if len(first) == len(keys) else np.maximum.reduceat(least[:, order], first, axis=1)


def takes_part(vector: str) -> Column:
    """The rule of ``usable`` for a vector column."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class QueryBlock:
    def __init__(self, ids: pa.Array, vectors: pa.Array):
        self.by_size = {x.shape[1]: (keys, Quantised(x)) for keys, x in usable(ids, vectors)}

    def nearest(self, batches: Iterator[tuple[pa.Array, pa.Array]], k: int) -> list[tuple[int, int, float]]:
        """``(query id, candidate id, cosine)`` of the nearest ``k`` of each query among the batches.

        A heap per query holds the best so far, its worst on top. Only pairs whose greatest possible
        cosine reaches that of the heap's worst, and of the k-th best least possible cosine of the
        tile, are computed in double precision.
        """
        heaps: dict[tuple[int, int], list] = {}
        for ids, vectors in batches:
            for keys, x in usable(ids, vectors):
                if x.shape[1] in self.by_size:
                    few = fewest_copies(keys, x, k + 1)
                    self._search(keys[few], Quantised(x[few]), heaps, k)
        found = []
        for (size, n), heap in heaps.items():
            query = int(self.by_size[size][0][n])
            found += [(query, -key, score) for score, key in heap]
        return found

    def _search(self, keys: np.ndarray, rows: Quantised, heaps: dict, k: int) -> None:
        size = rows.x.shape[1]
        ids, queries = self.by_size[size]
        for top in range(0, len(keys), TILE_ROWS):
            own = slice(top, min(top + TILE_ROWS, len(keys)))
            for left in range(0, len(ids), TILE_QUERIES):
                part = slice(left, min(left + TILE_QUERIES, len(ids)))
                least, most = queries.bounds(part, rows, own)
                itself = ids[part][:, None] == keys[own][None, :]
                least[itself] = most[itself] = -np.inf
                limit = np.array([h[0][0] if len(h := heaps.get((size, n), ())) == k else -np.inf
                                  for n in range(part.start, part.stop)])
                sure = best_of_each(keys[own], least)
                if sure.shape[1] >= k:
                    limit = np.maximum(limit, np.partition(sure, -k, axis=1)[:, -k])
                q, c = np.nonzero((most >= limit[:, None]) & ~itself)
                scores = queries.cosine(q + left, rows, c + top)
                for n, key, score in zip((q + left).tolist(), keys[c + top].tolist(), scores.tolist()):
                    heap, entry = heaps.setdefault((size, n), []), (score, -key)
                    known = next((i for i, (_, other) in enumerate(heap) if other == -key), None)
                    if known is not None:
                        heap[known] = max(heap[known], entry)
                        heapq.heapify(heap)
                    elif len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)


def query_blocks(queries: DataFrame, id_col: str, vector_col: str) -> Iterator[QueryBlock]:
    size = queries.agg((F.sum(F.size(vector_col)) * 20).alias("n")).first()["n"] or 0
    blocks = size // BLOCK_BYTES + 1
    for n in range(blocks):
        part = queries.where(F.pmod(F.xxhash64(id_col), F.lit(blocks)) == n).select(id_col, vector_col).toArrow()
        columns = [part.column(c).combine_chunks() for c in (id_col, vector_col)]
        yield QueryBlock(*columns)


def nearest(candidates: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` candidates with the largest cosine of each query.

    The search is exact. Every query is compared with every candidate of the same number of
    components but those of its own id, nearest first, ties to the smaller id. Queries go to
    the executors in blocks of bounded size; candidates are read where they lie, and each
    partition sends on ``k`` per query at most. Fewer candidates than ``k`` are all
    returned. Rows of one id with different vectors are one candidate with the larger cosine; of
    such queries any one row that can take part is taken. Vectors that are null, empty, zero or hold null or non-finite components,
    and those with a null id, take no part on either side. A repeated candidate counts once,
    repeated queries give one result; other columns are ignored. An empty table gives an
    empty result.
    """
    context = candidates.sparkSession.sparkContext
    rows = candidates.select(id_col, vector_col)
    parts = []
    asked = queries.where(takes_part(vector_col)).dropDuplicates([id_col])
    for block in query_blocks(asked, id_col, vector_col):
        shared = context.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            found = shared.value.nearest(((b.column(0), b.column(1)) for b in batches), k)
            columns = list(zip(*found)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())],
                names=["query_id", "vec_id", "score"])
        parts.append(rows.mapInArrow(search, "query_id bigint, vec_id bigint, score double"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # A candidate repeated in several partitions comes from each of them.
    return (found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(best))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


def op9_neighbours(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0))
