"""Inverted indices as long tables of postings and term statistics."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions.text import quoted, term_frequencies, terms, token_frequencies
from trawl.operators.joins import fits_broadcast, spread_join
from trawl.sources.shared import write_shared

# Cuts that a caller may ask for: body terms in so few or so many documents are of little use.
BODY_MIN_DF = 50
MAX_DF = 2_000_000
BLOCK_DOCS = 65_536


@dataclass(frozen=True)
class Index:
    """An inverted index.

    ``counted`` holds ``(term, doc_id, tf)``, at least for every term that keeps its
    postings. Terms with ``df <= min_df`` are unknown to the index. Terms with
    ``df >= max_df`` are known, with their statistics, but have no postings. By default
    nothing is cut.
    ``stored_stats`` and ``n_buckets`` are set for an index loaded from files, whose
    ``counted`` is already cut and has the partition column ``bucket``. If they were saved with it, ``blocks``
    holds ``(term, block, n, top_tf)``, the number of postings and the largest count of each term in each ``block_docs``
    consecutive ids, and ``by_term`` the postings once more as tables that are bucketed by term. Terms with
    more postings than one task should read are left out of those and stand in ``apart``. ``stored_lengths`` has
    ``(doc_id, length)``.
    """

    counted: DataFrame
    min_df: int = 0
    max_df: int | None = None
    stored_stats: DataFrame | None = None
    n_buckets: int | None = None
    blocks: DataFrame | None = None
    block_docs: int | None = None
    by_term: tuple[DataFrame, ...] = ()
    apart: DataFrame | None = None
    stored_lengths: DataFrame | None = None

    @property
    def lengths(self) -> DataFrame:
        """``(doc_id, length)``: the number of terms of each document with any, those of cut terms too."""
        if self.stored_lengths is not None:
            return self.stored_lengths
        if self.stored_stats is not None:
            raise ValueError("the index was saved without the lengths of its documents: save it with lengths=True")
        return self.counted.groupBy("doc_id").agg(F.sum("tf").alias("length"))

    @property
    def term_stats(self) -> DataFrame:
        """``(term, df, term_total)`` of every known term."""
        if self.stored_stats is not None:
            return self.stored_stats.select("term", "df", "term_total")
        return self._summarise(self.counted)

    def stats_of(self, wanted: DataFrame) -> DataFrame:
        """``term_stats`` of the terms in ``wanted`` only, a table small enough to broadcast.

        For an unsaved index, postings of other terms are dropped before they are aggregated.
        """
        wanted = F.broadcast(wanted.select("term"))
        if self.stored_stats is not None:
            return self.term_stats.join(wanted, "term", "left_semi")
        return self._summarise(self.counted.join(wanted, "term", "left_semi"))

    def _summarise(self, counted: DataFrame) -> DataFrame:
        return (counted.groupBy("term")
                .agg(F.count("*").alias("df"), F.sum("tf").alias("term_total"))
                .where(F.col("df") > self.min_df))

    @property
    def posted_terms(self) -> DataFrame:
        """Statistics of the terms that have postings."""
        return self.term_stats.where(self.is_posted())

    def is_posted(self) -> Column:
        return F.lit(True) if self.max_df is None else F.col("df") < self.max_df

    @property
    def is_cut(self) -> bool:
        """Whether ``counted`` still holds postings that the cuts take out."""
        return self.n_buckets is None and (self.min_df > 0 or self.max_df is not None)

    def materialised(self) -> Index:
        """The same index with its counted terms written, so that several uses tokenise once."""
        if self.n_buckets is not None:
            return self
        return replace(self, counted=write_shared(self.counted.select("term", "doc_id", "tf"), "counted"))

    @cached_property
    def postings(self) -> DataFrame:
        """``(term, doc_id, tf)`` after both cuts.

        Without cuts these are the counted terms as they are. For a cut those are written and
        counted. A hot cut alone leaves the postings where they are, unless the hot
        terms are measured to be too many to broadcast; a rare cut exchanges them once.
        """
        if not self.is_cut:
            return self.counted.select("term", "doc_id", "tf")
        index = self.materialised()
        if self.min_df > 0:
            return cut_postings(index.counted, index.posted_terms)
        hot = index.term_stats.where(~self.is_posted())
        if fits_broadcast(hot, "term"):
            return index.counted.join(F.broadcast(hot.select("term")), "term", "left_anti")
        return cut_postings(index.counted, index.posted_terms)

    def restricted_to(self, wanted: list[str]) -> Index:
        """The same index, reading only the buckets and row groups that can hold ``wanted``."""
        if self.n_buckets is None:
            return self
        literals = [quoted(t) for t in wanted]
        buckets = [f"CAST(pmod(xxhash64({t}), {self.n_buckets}) AS INT)" for t in literals]
        chosen = F.expr(f"bucket IN ({', '.join(buckets)}) AND term IN ({', '.join(literals)})")
        return replace(self, counted=self.counted.where(chosen), stored_stats=self.stored_stats.where(chosen),
                       blocks=None if self.blocks is None else self.blocks.where(chosen))


def block_of(doc_id: str, block_docs: int) -> Column:
    """The number of a document's block of consecutive ids, also of negative ones."""
    return F.expr(f"({doc_id} - pmod({doc_id}, {block_docs})) div {block_docs}")


def term_bucket(term, n_buckets: int):
    return F.pmod(F.xxhash64(term), F.lit(n_buckets)).cast("int")


def cut_postings(counted: DataFrame, kept: DataFrame, small: bool = False) -> DataFrame:
    """Postings of the terms in ``kept (term, df)``.

    Unless ``kept`` is known to be small, it is taken as too large to broadcast: both
    sides are shuffled, and frequent terms are split by their df, which is their
    number of postings.
    """
    if small:
        return counted.join(F.broadcast(kept.select("term")), "term", "left_semi")
    return spread_join(counted, kept.select("term"), ["term"],
                       kept.select("term", F.col("df").alias("load")), ["doc_id"], "left_semi")


def build_index(corpus: DataFrame, source_col: str, id_col: str = "id",
                stopwords: Iterable[str] | None = None,
                min_df: int = 0, max_df: int | None = None) -> Index:
    """Index over one text column; nothing is cut unless asked for."""
    return Index(term_frequencies(corpus.select(id_col, source_col), id_col, source_col, stopwords),
                 min_df, max_df)


def build_anchor_index(links: DataFrame, stopwords: Iterable[str] | None = None,
                       min_df: int = 0, max_df: int | None = None) -> Index:
    """Index of link texts under the page they point to, from ``(src, dst, text)``.

    Equal texts of one target are counted before they are tokenised, and the
    counts are added up per target and term, so a page that a large share of all
    links point to is reduced map-side.
    """
    texts = links.groupBy(F.col("dst").alias("doc_id"), "text").agg(F.count("*").alias("n"))
    tokens = texts.select("doc_id", "n", F.explode(terms("text", stopwords)).alias("term"))
    counted = tokens.groupBy("term", "doc_id").agg(F.sum("n").cast("int").alias("tf"))
    return Index(counted, min_df, max_df)


def index_of_tokens(docs: DataFrame, min_df: int = 0, max_df: int | None = None) -> Index:
    """Index over documents that come tokenised: ``(doc_id, tokens)``."""
    return Index(token_frequencies(docs), min_df, max_df)


def add_docs(index: Index, docs: DataFrame) -> Index:
    """The index with further tokenised documents; statistics follow from the joint postings."""
    check_extensible(index)
    added = token_frequencies(docs)
    counted = index.counted.select("term", "doc_id", "tf").unionByName(added)
    if index.stored_stats is None:
        return Index(counted, index.min_df, index.max_df)
    stats = (index.term_stats
             .unionByName(Index(added).term_stats)
             .groupBy("term").agg(F.sum("df").alias("df"), F.sum("term_total").alias("term_total")))
    return Index(counted, index.min_df, index.max_df, stats)


def check_extensible(index: Index) -> None:
    if index.stored_stats is not None and index.min_df > 0:
        raise ValueError("a saved index without its rare terms cannot be extended: build it with min_df=0")


def posting_list(index: Index, term: str) -> DataFrame:
    """``(doc_id, tf)`` of one term by doc_id; empty for an unknown term."""
    return posting_lists(index, [term]).select("doc_id", "tf").orderBy("doc_id")


def posting_lists(index: Index, wanted: list[str]) -> DataFrame:
    """Postings of a few named terms, read through the bucket and row-group bounds.

    The rows of a term are all it has, so a cut counts the rows that were found.
    """
    found = index.restricted_to(wanted).counted.where(F.col("term").isin(wanted)).select("term", "doc_id", "tf")
    if not index.is_cut:
        return found
    return replace(index, counted=found).postings


def scan_postings(index: Index) -> DataFrame:
    """All postings in term and document order.

    The sort is by range over (term, doc_id), so a frequent term spans partitions.
    """
    return index.postings.orderBy("term", "doc_id")


def posting_blocks(index: Index, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Posting lists as arrays, ``(term, block, postings)``.

    A list is laid out in blocks of ``block_docs`` consecutive ids: joined up in
    block order they are the whole list, and no array exceeds ``block_docs`` entries.
    """
    return (index.postings
            .groupBy("term", block_of("doc_id", block_docs).alias("block"))
            .agg(F.sort_array(F.collect_list(F.struct("doc_id", "tf"))).alias("postings")))
