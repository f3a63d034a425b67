"""Scoring of query batches.

A batch is ``queries (query_id, query)``, one row per query. All rankers work alike.
The query side is a table of weighted terms. If it is measured to be small, it is
broadcast: postings of other terms are dropped in the scan, the rest is
exchanged once by document, and only then meets the query terms, in as many tasks as the
number of pairs asks for, so that each
(query, document) score is summed in place and the best k of each query are picked
before the second and last exchange. A larger batch is joined by shuffle, with terms split
by the number of pairs they yield.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.functions import scoring
from trawl.functions.text import count_tokens, terms
from trawl.operators.indexing import Index, block_of
from trawl.operators.joins import (BROADCAST_BYTES, ROW_BYTES, fits_broadcast, heavy_keys, lookup_join, rows_and_bytes,
                                   spread_join, token_bytes)
from trawl.operators.signals import top_of
from trawl.sources.shared import write_shared

TOP_K = 100
BODY, TITLE, ANCHOR = "body", "title", "anchor"
WEIGHTS = {BODY: 0.60, TITLE: 0.20, ANCHOR: 0.10, "pagerank": 0.05, "pageviews": 0.05}
K1, B = 1.5, 0.75
# A batch with at most this many distinct terms has them pushed into the scan of a saved index.
PUSHED_TERMS = 1_000
# Pairs of a query and a document that one task sums and ranks, at some 200 bytes of memory each.
TASK_PAIRS = 1_000_000
# Ranges of ids pushed into the scan when whole blocks are passed over.
PUSHED_RANGES = 100


def query_terms(queries: DataFrame, stopwords: Iterable[str] | None = None) -> DataFrame:
    """``(query_id, q_len, term, q_tf)``: distinct terms with their counts; q_len is their number."""
    tokens = queries.select("query_id", terms("query", stopwords).alias("tokens"))
    lengths = tokens.withColumn("q_len", F.greatest(F.lit(1), F.size(F.array_distinct("tokens"))))
    return count_tokens(lengths, ["query_id", "q_len"], F.col("tokens"), count="q_tf")


def search_body(index: Index, queries: DataFrame, n_docs: Column | int, k: int | None = TOP_K,
                titles: DataFrame | None = None, stopwords: Iterable[str] | None = None,
                broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """TF-IDF cosine over the body. Both norms run over the query's terms only."""
    batch = _Batch({BODY: index}, queries, stopwords, broadcast_bytes, n_docs)
    scores = batch.score(_cosine_weights(batch.known_terms(), n_docs), _cosine_sums())
    return batch.titled(top_k(scores.select("query_id", "doc_id", _cosine().alias("score")), k), titles, k)


def search_binary(index: Index | None, queries: DataFrame, k: int | None = TOP_K,
                  titles: DataFrame | None = None, stopwords: Iterable[str] | None = None,
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Number of distinct query terms a document's title or anchors hold; no index, no results."""
    if index is None:
        empty = queries.sparkSession.createDataFrame([], "query_id bigint, doc_id bigint, score double")
        return resolve_titles(top_k(empty, k), titles)
    batch = _Batch({TITLE: index}, queries, stopwords, broadcast_bytes)
    scores = batch.score(batch.known_terms(), [F.count("*").cast("double").alias("score")])
    return batch.titled(top_k(scores, k), titles, k)


search_title = search_anchor = search_binary


def search_bm25(index: Index, queries: DataFrame, k1: float = K1, b: float = B,
                n: Column | int | None = None, k: int | None = TOP_K,
                titles: DataFrame | None = None, stopwords: Iterable[str] | None = None,
                broadcast_bytes: int = BROADCAST_BYTES, prune: bool = True, lengths: bool = False) -> DataFrame:
    """BM25 with fixed document length. ``n`` is the number of terms with postings unless given.

    With every length taken as average, ``b`` has no effect. With ``lengths`` it has: a document's length, its number
    of terms, over the mean length of documents with any, makes the fraction ``b`` of ``k1``. That needs an index
    that is not saved, or was saved with lengths.
    With ``k=None`` all matches are returned, their rank left empty.

    Over an index that was saved with the largest count of each term and block, ``prune`` passes over the blocks
    whose documents cannot be among a query's best ``k``. The result is the same. It takes two passes, the
    first of which runs when the search is called, not when its result is read.
    """
    if n is None:
        index = index.materialised()
        n = index.posted_terms.agg(F.count("*")).scalar()
    batch = _Batch({BODY: index}, queries, stopwords, broadcast_bytes)
    weights = batch.known_terms().withColumn("weight", F.col("q_tf") * scoring.bm25_idf(F.col("df"), n))
    by_length, least = F.lit(1.0), 1.0
    if lengths:
        batch.lengths = index.lengths
        mean = batch.lengths.agg(F.avg("length")).scalar()
        by_length, least = 1 - b + b * F.col("length") / mean, 1 - b
    gain = scoring.bm25_gain(F.col("weight"), F.col("tf"), k1, by_length)
    if prune and k is not None and batch.small and index.blocks is not None:
        # No document of a block gains more than one without any length would.
        most = scoring.bm25_gain(F.col("weight"), F.col("top_tf"), k1, least)
        found = _Blocks(batch, weights, gain, most, k, broadcast_bytes).best()
        if found is not None:
            return batch.titled(found, titles, k)
    return batch.titled(top_k(batch.score(weights, [F.sum(gain).alias("score")]), k), titles, k)


def search(body: Index, title: Index, anchor: Index | None, queries: DataFrame, n_docs: Column | int,
           pagerank: DataFrame | None = None, pageviews: DataFrame | None = None,
           titles: DataFrame | None = None, k: int | None = TOP_K,
           stopwords: Iterable[str] | None = None, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Weighted blend of body cosine, title and anchor matches, PageRank and page views.

    A document counts as soon as one of the three indices matches it. The indices
    are scored in one pass over the union of their postings.
    """
    indexes = {BODY: body, TITLE: title} | ({} if anchor is None else {ANCHOR: anchor})
    batch = _Batch(indexes, queries, stopwords, broadcast_bytes)
    matches = [F.count_if(F.col("field") == f).alias(f) for f in (TITLE, ANCHOR)]
    signals = {name: table for name, table in (("pagerank", pagerank), ("pageviews", pageviews))
               if table is not None}
    scored = batch.score(_cosine_weights(batch.known_terms(), n_docs),
                         [*_cosine_sums(), *matches, F.max("q_len").alias("q_len")], signals)

    share = lambda c: F.col(c) / F.col("q_len")
    parts = {BODY: F.coalesce(_cosine(), F.lit(0.0)), TITLE: share(TITLE), ANCHOR: share(ANCHOR)}
    blend = {f: F.lit(WEIGHTS[f]) for f in parts}
    norms = {"pagerank": ("pagerank", scoring.norm_linear), "pageviews": ("views", scoring.norm_log)}
    for name, table in signals.items():
        value, norm = norms[name]
        top = top_of(table, value)
        parts[name] = norm(F.coalesce(F.col(name), F.lit(0)), top)
        blend[name] = F.when(top != 0, F.lit(WEIGHTS[name])).otherwise(F.lit(0.0))
    total = reduce(Column.__add__, blend.values())
    score = reduce(Column.__add__, [blend[name] / total * parts[name] for name in parts])
    return batch.titled(top_k(scored.select("query_id", "doc_id", score.alias("score")), k), titles, k)


def top_k(scores: DataFrame, k: int | None) -> DataFrame:
    """Best k documents per query, with their rank; ties go to the lower doc_id.

    Up to the session's group-limit threshold Spark keeps only k rows per query and
    partition before it exchanges by query. For a larger k, a first cut is made per query
    and slice of documents, so that no task receives all of a query's documents.
    """
    spark = scores.sparkSession
    keyed = scores.withColumn("_key", scoring.sort_key(F.col("score")))
    order = [F.col("_key").desc(), F.col("doc_id")]
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    if k is None:  # every match, unranked: a caller who wants an order sorts, or asks for k
        return keyed.select("query_id", F.lit(None).cast("int").alias("rank"), "doc_id", "score")
    if k > int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
        per_slice = Window.partitionBy("query_id", "_slice").orderBy(*order)
        keyed = (keyed.withColumn("_slice", F.pmod(F.xxhash64("doc_id"), F.lit(slices)))
                 .withColumn("_rank", F.row_number().over(per_slice)).where(F.col("_rank") <= k))
    return (keyed.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "doc_id", "score"))


def resolve_titles(results: DataFrame, titles: DataFrame | None, most_rows: int | None = None) -> DataFrame:
    """Add the title, or the id as text where there is none.

    Only titles of documents among the results are moved. Results known to have few enough rows, ``most_rows``
    at most, have their ids broadcast, and nothing is run before the table is read. Others are
    written first, and a document in a large share of them is split.
    """
    fallback = F.col("doc_id").cast("string")
    if titles is None:
        named = results.withColumn("title", fallback)
    elif most_rows is not None and most_rows * ROW_BYTES <= BROADCAST_BYTES:
        # Counting over the score makes the ids read the very exchange that ends the search, so that it runs once.
        ids = results.groupBy("doc_id").agg(F.count_if(F.col("score") < float("inf")).alias("n")).where("n >= 0")
        wanted = (titles.join(F.broadcast(ids.select(F.col("doc_id").alias("id"))), "id", "left_semi")
                  .select(F.col("id").alias("doc_id"), "title"))
        named = results.join(wanted, "doc_id", "left").withColumn("title", F.coalesce("title", fallback))
    else:
        results = write_shared(results, "results")
        ids = results.select(F.col("doc_id").alias("id")).distinct()
        wanted = titles.join(ids, "id", "left_semi").select(F.col("id").alias("doc_id"), "title")
        named = (lookup_join(results, wanted, "doc_id", ["query_id"], "left")
                 .withColumn("title", F.coalesce("title", fallback)))
    return named.select("query_id", "rank", "doc_id", "title", "score")


def _cosine_weights(known: DataFrame, n_docs: Column | int) -> DataFrame:
    """Body weights and the query's norm, in which known terms without postings count too."""
    weighted = (known
                .withColumn("idf", F.when(F.col("field") == BODY, scoring.idf(F.col("df"), n_docs)))
                .withColumn("weight", F.col("q_tf") * F.col("idf")))
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy("query_id")))
    return weighted.withColumn("q_norm", scoring.or_one(norm))


def _cosine_sums() -> list[Column]:
    weight = F.col("tf") * F.col("idf")
    return [
        F.sum(weight * F.col("weight")).alias("_dot"),
        F.sum(weight * weight).alias("_norm2"),
        F.max("q_norm").alias("_q_norm"),
    ]


def _cosine() -> Column:
    return F.col("_dot") / (scoring.or_one(F.sqrt("_norm2")) * F.col("_q_norm"))


class _Batch:
    """The query side of one search and its join with the postings of some indices."""

    def __init__(self, indexes: dict[str, Index], queries: DataFrame,
                 stopwords: Iterable[str] | None, broadcast_bytes: int, most_docs: Column | int | None = None):
        self.terms = query_terms(queries, stopwords)
        self.lengths: DataFrame | None = None
        self.n_queries, text_bytes = rows_and_bytes(queries, "query")
        self.small = token_bytes(text_bytes, len(indexes)) <= broadcast_bytes
        self.indexes = self._push_terms(indexes) if self.small else indexes
        if not self.small:
            self.terms = write_shared(self.terms, "query-terms")
            self.indexes = self._of_asked_terms()
        self.postings = _by_field({f: i.counted.select("term", "doc_id", "tf") for f, i in self.indexes.items()})
        if self.small:
            wanted = F.broadcast(self.terms.select("term"))
            self.postings = self._by_document(self.postings.join(wanted, "term", "left_semi"), most_docs)

    def _by_document(self, postings: DataFrame, most_docs: Column | int | None) -> DataFrame:
        """Asked postings by document, in tasks of about ``TASK_PAIRS`` pairs with the terms of queries.

        No query finds more than ``most_docs`` documents, which bounds the pairs and tells without a scan whether one
        task could take all. Otherwise they are counted: from saved statistics, or over the asked postings, which are then
        written, so that they are tokenised once.
        """
        if isinstance(most_docs, Column):
            most_docs = self.terms.sparkSession.range(1).select(most_docs.alias("n")).first()["n"]
        most = None if most_docs is None else most_docs * self.n_queries
        if most is not None and most <= TASK_PAIRS:
            return postings.repartition("doc_id")
        if all(i.stored_stats is not None for i in self.indexes.values()):
            sizes = _by_field({f: i.posted_terms for f, i in self.indexes.items()})
        else:
            postings = write_shared(postings, "asked-postings")
            sizes = postings.groupBy("field", "term").agg(F.count("*").alias("df"))
        asked = self.terms.groupBy("term").agg(F.count("*").alias("n"))
        tasks = _tasks_of(sizes.join(F.broadcast(asked), "term"), F.col("df") * F.col("n"), most)
        return postings.repartition("doc_id") if tasks is None else postings.repartition(tasks, "doc_id")

    def titled(self, results: DataFrame, titles: DataFrame | None, k: int | None) -> DataFrame:
        return resolve_titles(results, titles, None if k is None else k * self.n_queries)

    def _of_asked_terms(self) -> dict[str, Index]:
        """Unsaved indices with their counted terms written, so that statistics and scores tokenise once.

        Where the batch's distinct terms are few enough to broadcast, no others are written.
        """
        asked = self.terms.select("term").distinct()
        if all(i.n_buckets is not None for i in self.indexes.values()):
            return self.indexes
        if fits_broadcast(asked, "term"):
            return {f: i if i.n_buckets is not None else
                    replace(i, counted=i.counted.join(F.broadcast(asked), "term", "left_semi")).materialised()
                    for f, i in self.indexes.items()}
        return {f: i.materialised() for f, i in self.indexes.items()}

    def known_terms(self) -> DataFrame:
        """``(field, term, df, query_id, q_len, q_tf)`` for the query terms an index knows."""
        if not self.small:
            return self._join_terms(_by_field({f: i.term_stats for f, i in self.indexes.items()}))
        stored = {f: i.term_stats for f, i in self.indexes.items() if i.stored_stats is not None}
        parts = [_by_field(stored).select("field", "term", "df")] if stored else []
        if len(stored) < len(self.indexes):
            # Counting over tf makes this read the very exchange that is scored later, so
            # Spark runs it once. For the same reason fields are told apart only afterwards.
            counted = self.postings.groupBy("field", "term").agg(F.count_if(F.col("tf") > 0).alias("df"))
            parts.append(counted.where(~F.col("field").isin(list(stored)) if stored else F.lit(True))
                         .where(F.col("df") > self._limit("min_df")))
        return reduce(DataFrame.unionByName, parts).join(F.broadcast(self.terms), "term")

    def _join_terms(self, stats: DataFrame) -> DataFrame:
        """The same by shuffle; a term that many queries ask for is split by their number.

        The terms are written once, as they are read several times to balance the join.
        """
        used = self.terms.groupBy("term").agg(F.count("*").alias("load"))
        known = write_shared(stats.select("field", "term", "df").join(used, "term"), "known-terms")
        loads = known.groupBy("term").agg(F.max("load").alias("load"))
        return spread_join(self.terms, known.drop("load"), ["term"], loads, ["query_id"])

    def score(self, weights: DataFrame, sums: list[Column],
              signals: dict[str, DataFrame] | None = None) -> DataFrame:
        """``(query_id, doc_id)`` with the given sums over matching postings, and the document's signals."""
        on, pair, signals = ["field", "term"], ["query_id", "doc_id"], signals or {}
        limit = self._limit("max_df")
        weights = weights.where(limit.isNull() | (F.col("df") < limit))
        if self.small:
            # Grouped where the documents' postings are, so the signals come to the same partitions.
            matched = self.with_lengths(self.postings).join(F.broadcast(weights), on)
            return _with_signals(matched.groupBy(*pair).agg(*sums), signals)
        weights = write_shared(weights, "query-weights")
        loads = weights.groupBy(*on).agg((F.max("df").cast("double") * F.count("*")).alias("load"))
        if self.lengths is None and all(i.by_term for i in self.indexes.values()):
            matched = self._join_by_term(weights, loads)
        else:
            matched = spread_join(self.with_lengths(self.postings), weights, on, loads, ["doc_id"])
        tasks = _tasks_of(weights, F.col("df"))
        summed = (matched if tasks is None else matched.repartition(tasks, *pair)).groupBy(*pair).agg(*sums)
        if signals:
            summed = write_shared(summed, "sums")
        for name, table in signals.items():
            summed = lookup_join(summed, _signal(name, table), "doc_id", ["query_id"], "left")
        return summed

    def with_lengths(self, postings: DataFrame) -> DataFrame:
        """Postings with their documents' lengths if those are asked for, which come to where the documents are."""
        return postings if self.lengths is None else postings.join(self.lengths, "doc_id")

    def _join_by_term(self, weights: DataFrame, loads: DataFrame) -> DataFrame:
        """Postings that lie bucketed by term, joined there; only weights are moved to them.

        Terms that make more pairs than a task should are taken out, and joined by shuffle with those that were
        saved apart.
        """
        on = ["field", "term"]
        heavy = heavy_keys(loads, on).drop("_parts")
        calm, busy = weights.join(heavy, on, "left_anti"), []
        parts = []
        for field, index in self.indexes.items():
            of_field = calm.where(F.col("field") == field)
            own = heavy.where(F.col("field") == field).select("term")
            for table in index.by_term:
                light = table.join(F.broadcast(own), "term", "left_anti")
                parts.append(light.join(of_field, "term"))
                busy.append(table.join(F.broadcast(own), "term", "left_semi").withColumn("field", F.lit(field)))
            busy.append(index.apart.withColumn("field", F.lit(field)))
        parts.append(spread_join(reduce(DataFrame.unionByName, busy), weights, on, loads, ["doc_id"]))
        return reduce(DataFrame.unionByName, parts)

    def _limit(self, name: str) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for f, i in self.indexes.items() for x in (f, getattr(i, name))]),
                            F.col("field")).cast("bigint")

    def _push_terms(self, indexes: dict[str, Index]) -> dict[str, Index]:
        """Let a short list of terms choose the buckets and row groups to read of saved indices."""
        if all(i.n_buckets is None for i in indexes.values()):
            return indexes
        wanted = [r["term"] for r in self.terms.select("term").distinct().limit(PUSHED_TERMS + 1).collect()]
        if len(wanted) > PUSHED_TERMS:
            return indexes
        return {f: i.restricted_to(wanted) for f, i in indexes.items()}


class _Blocks:
    """The search for the best ``k`` documents of each query that passes over blocks of documents.

    The sum of what each term can add at most within a block bounds the scores of its documents. Blocks with the highest
    bounds that hold ``k`` matches for certain are scored first; the k-th best score found there is one that a document
    must reach, so only the blocks whose bounds do are scored after them. Documents are in one block each, so
    scores are whole.
    """

    # Bounds and scores are sums in different orders.
    SLACK = 1e-6

    def __init__(self, batch: _Batch, weights: DataFrame, gain: Column, most: Column, k: int, broadcast_bytes: int):
        limit, index = batch._limit("max_df"), batch.indexes[BODY]
        self.batch, self.index, self.gain, self.k, self.broadcast_bytes = batch, index, gain, k, broadcast_bytes
        self.weights = weights.where(limit.isNull() | (F.col("df") < limit)).select("query_id", "term", "weight")
        self.bounds = write_shared(
            index.blocks.join(F.broadcast(self.weights), "term").groupBy("query_id", "block")
            .agg(F.sum(F.greatest(F.lit(0.0), most)).alias("bound"), F.max("n").alias("docs"), F.count("*").alias("terms")), "bounds")

    def best(self) -> DataFrame | None:
        """``(query_id, rank, doc_id, score)``; None if the blocks and terms are too many to broadcast."""
        size = self.bounds.agg(F.sum("terms").alias("n")).first()["n"] or 0
        if size * ROW_BYTES > self.broadcast_bytes:
            return None
        first, others = self.first_blocks(), None
        seen = write_shared(top_k(self.scores(first), self.k), "first-best").drop("rank")
        reached = self.reached(seen)
        others = self.others(first, reached)
        return top_k(seen.unionByName(self.scores(others)), self.k)

    def first_blocks(self) -> DataFrame:
        """``(query_id, block)`` of the highest bounds, until they hold k matches; k of them do for certain."""
        order = Window.partitionBy("query_id").orderBy(F.col("bound").desc(), "block")
        leading = self.bounds.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= self.k)
        before = F.sum("docs").over(order.rowsBetween(Window.unboundedPreceding, -1))
        return leading.withColumn("_before", F.coalesce(before, F.lit(0))).where(F.col("_before") < self.k).select(
            "query_id", "block")

    def reached(self, seen: DataFrame) -> DataFrame:
        """``(query_id, least)``: the k-th best score of the queries that have k."""
        return (seen.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
                .where(F.col("n") >= self.k).select("query_id", "least"))

    def others(self, first: DataFrame, reached: DataFrame) -> DataFrame:
        """``(query_id, block)`` of the blocks left whose bounds reach the score."""
        slack = self.SLACK * (1 + F.abs("least"))
        left = self.bounds.join(reached, "query_id", "left").where(
            F.col("least").isNull() | (F.col("bound") >= F.col("least") - slack))
        return left.join(first, ["query_id", "block"], "left_anti").select("query_id", "block")

    def scores(self, chosen: DataFrame) -> DataFrame:
        """``(query_id, doc_id, score)`` of all documents in the chosen blocks of each query."""
        chosen = write_shared(chosen, "blocks")
        wanted = chosen.join(F.broadcast(self.weights), "query_id")
        block = block_of("doc_id", self.index.block_docs).alias("block")
        postings = self.index.counted.where(self._ranges(chosen)).select("term", "doc_id", "tf", block)
        matched = self.batch.with_lengths(postings.join(F.broadcast(wanted), ["term", "block"]))
        return matched.groupBy("query_id", "doc_id").agg(F.sum(self.gain).alias("score"))

    def _ranges(self, chosen: DataFrame) -> Column:
        """The chosen blocks' ids as a condition for the scan, where they make few ranges."""
        most = self.k * PUSHED_RANGES
        blocks = sorted(r["block"] for r in chosen.select("block").distinct().limit(most + 1).collect())
        starts = [b for b, before in zip(blocks, [None, *blocks]) if before is None or b != before + 1]
        if len(blocks) > most or len(starts) > PUSHED_RANGES:
            return F.lit(True)
        ends = [b for b, after in zip(blocks, [*blocks[1:], None]) if after is None or b != after - 1]
        size, doc = self.index.block_docs, F.col("doc_id")
        ranges = [doc.between(a * size, (b + 1) * size - 1) for a, b in zip(starts, ends)]
        return reduce(Column.__or__, ranges, F.lit(False))


def _tasks_of(rows: DataFrame, pairs: Column, most: int | None = None) -> int | None:
    """Tasks for the ``pairs`` that all rows make, ``most`` at most, and as many tasks as exchanges have or more.

    None if one task may take them all. Named, the number stays as it is: Spark would put tasks together by the bytes
    of postings, of which each may make a pair with every query.
    """
    total = rows.agg(F.sum(pairs).alias("n")).first()["n"] or 0
    total = total if most is None else min(total, most)
    if total <= TASK_PAIRS:
        return None
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_PAIRS))


def _by_field(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [t.withColumn("field", F.lit(f)) for f, t in tables.items()])


def _with_signals(by_doc: DataFrame, signals: dict[str, DataFrame]) -> DataFrame:
    """Left-join ``(id, value)`` tables under their names, by doc_id."""
    for name, table in signals.items():
        by_doc = by_doc.join(_signal(name, table), "doc_id", "left")
    return by_doc


def _signal(name: str, table: DataFrame) -> DataFrame:
    value = next(c for c in table.columns if c != "id")
    return table.select(F.col("id").alias("doc_id"), F.col(value).alias(name))
