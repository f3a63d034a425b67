"""Saving and loading indices and signals as Parquet."""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import reduce
from itertools import accumulate

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl import schemas
from trawl.functions.text import quoted
from trawl.operators.indexing import Index, block_of, check_extensible, cut_postings, term_bucket
from trawl.operators.joins import fits_broadcast
from trawl.sources.shared import write_shared

N_BUCKETS = 124
# Rows that one task sorts and writes, at some 90 bytes of memory each.
SLICE_POSTINGS = 2_000_000

# Bloom filters beside each row group, by which a look-up of a term that is not there reads no rows.
ABSENT_TERMS = {"parquet.bloom.filter.enabled#term": "true", "parquet.bloom.filter.adaptive.enabled": "true"}

_BUCKET = T.StructField("bucket", T.IntegerType())
_VERSION = T.StructField("version", T.IntegerType())


def save_index(index: Index, path: str, n_buckets: int = N_BUCKETS,
               slice_postings: int = SLICE_POSTINGS, mode: str = "error",
               block_docs: int | None = None, by_term: bool = False, lengths: bool = False) -> None:
    """Write statistics, then postings, one folder per term bucket, sorted by term and doc_id.

    A bucket with more than ``slice_postings`` postings, be they of one term, is
    divided by document into slices, each written by one task; its statistics are divided by term, its
    block bounds by term and block. ``info`` goes first, marked
    as incomplete, and again last: a save that broke off is never loaded.

    With ``block_docs`` the largest count of each term in each block of so many ids is saved, by which searches
    pass over blocks. With ``by_term`` the postings are saved once more, bucketed by term, in ``n_buckets`` or as
    many as hold ``slice_postings`` each, so that
    large batches join them where they are; with ``lengths`` the documents' lengths, which BM25 may use. Segments added to an index that is overwritten are forgotten.

    The counted terms are written before all else, as they are read twice and tokenising
    costs far more than reading its result back.
    """
    spark = index.counted.sparkSession
    info = (index.min_df, index.max_df, n_buckets, block_docs, by_term, lengths, None)
    _write_info(spark, info, path, False, mode)
    index, bucket = index.materialised(), term_bucket(F.col("term"), n_buckets)
    counted_stats = write_shared(index.term_stats.withColumn("bucket", bucket), "term-stats")
    # One row per bucket, so n_buckets rows at most.
    sizes = counted_stats.groupBy("bucket").agg(
        F.count("*").alias("terms"), F.sum(F.when(index.is_posted(), F.col("df"))).alias("postings")).collect()
    of_terms = _Slices({r["bucket"]: r["terms"] for r in sizes}, n_buckets, slice_postings)
    of_postings = _Slices({r["bucket"]: r["postings"] or 0 for r in sizes}, n_buckets, slice_postings)
    (counted_stats.repartitionById(of_terms.number, of_terms.slice_of(F.hash("term")))
     .sortWithinPartitions("bucket", "term")
     .write.mode(mode).options(**ABSENT_TERMS).partitionBy("bucket").parquet(f"{path}/term_stats"))
    stats = _read(spark, f"{path}/term_stats", schemas.TERM_STATS)
    posted = stats.where(index.is_posted())

    postings = index.counted.select("term", "doc_id", "tf")
    if index.is_cut:
        postings = cut_postings(postings, posted, small=fits_broadcast(posted, "term"))
    (postings.withColumn("bucket", bucket)
     .repartitionById(of_postings.number, of_postings.slice_of(F.xxhash64("doc_id")))
     .sortWithinPartitions("bucket", "term", "doc_id")
     .write.mode(mode).options(**ABSENT_TERMS).partitionBy("bucket").parquet(f"{path}/postings"))
    saved = _read(spark, f"{path}/postings", schemas.POSTINGS)
    if block_docs is not None:
        _save_blocks(saved, path, of_postings, block_docs, mode)
    if lengths:
        index.lengths.write.mode(mode).parquet(f"{path}/lengths")
    if by_term:
        term_buckets = max(n_buckets, -(-of_postings.rows // slice_postings))
        info = (*info[:-1], term_buckets)
        _save_by_term(saved, stats.where(F.col("df") > slice_postings), path, term_buckets, mode)
    if segments_of(spark, path)[1]:
        _write_manifest(spark, path, [])
    _write_info(spark, info, path, True, "overwrite")


class _Slices:
    """Buckets divided by a hash into slices of about ``most`` rows, each for one task."""

    def __init__(self, sizes: dict[int, int], n_buckets: int, most: int):
        self.rows = sum(sizes.values())
        self.slices = [max(1, -(-sizes.get(b, 0) // most)) for b in range(n_buckets)]
        self.firsts = list(accumulate(self.slices, initial=0))
        self.number = self.firsts[-1]

    def slice_of(self, hashed: Column) -> Column:
        """The slice of a row with the column ``bucket``, by a hash other than that of its bucket."""
        of_bucket = lambda values: F.element_at(F.lit(values), F.col("bucket") + 1)
        return (of_bucket(self.firsts) + F.pmod(hashed, of_bucket(self.slices))).cast("int")


def _save_blocks(postings: DataFrame, path: str, slices: _Slices, block_docs: int, mode: str) -> None:
    """Blocks may be nearly as many as postings, so they are counted and written by as many tasks."""
    keys = ["bucket", "term", "block"]
    blocks = (postings.select("bucket", "term", block_of("doc_id", block_docs).alias("block"), "tf")
              .repartition(slices.number, *keys).groupBy(*keys)
              .agg(F.count("*").alias("n"), F.max("tf").alias("top_tf")))
    (blocks.repartitionById(slices.number, slices.slice_of(F.xxhash64("term", "block"))).sortWithinPartitions(*keys)
     .write.mode(mode).partitionBy("bucket").parquet(f"{path}/blocks"))


def _save_by_term(postings: DataFrame, large: DataFrame, path: str, term_buckets: int, mode: str) -> None:
    """Bucketed by term, a bucket a task, without the ``large`` terms, of which there are fewer than 1 / slice_postings of all postings."""
    spark = postings.sparkSession
    apart = F.broadcast(large.select("term")) if fits_broadcast(large, "term") else large.select("term")
    (postings.join(apart, "term", "left_semi").select("term", "doc_id", "tf")
     .write.mode(mode).parquet(f"{path}/apart"))
    name = _table_name()
    (postings.join(apart, "term", "left_anti").select("term", "doc_id", "tf")
     .repartition(term_buckets, "term").sortWithinPartitions("term", "doc_id")
     .write.mode(mode).format("parquet").option("path", f"{path}/by_term")
     .bucketBy(term_buckets, "term").sortBy("term").saveAsTable(name))
    # The catalog's entry is made anew by each session that loads the index; the files stay.
    spark.sql(f"DROP TABLE {name}")


def _table_name() -> str:
    return f"postings_{uuid.uuid4().hex}"


def _read_by_term(spark: SparkSession, path: str, term_buckets: int) -> DataFrame:
    name = _table_name()
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.POSTINGS.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (term) SORTED BY (term) "
              f"INTO {term_buckets} BUCKETS LOCATION {quoted(path)}")
    return spark.table(name)


def _write_info(spark: SparkSession, info: tuple, path: str, complete: bool, mode: str) -> None:
    row = (*info[:3], complete, *info[3:])
    spark.createDataFrame([row], schemas.INDEX_INFO).coalesce(1).write.mode(mode).parquet(f"{path}/info")


def load_index(spark: SparkSession, path: str, fallback: str | None = None,
               missing_ok: bool = False) -> Index | None:
    """Load a saved index, from ``fallback`` if there is none, or an incomplete one, at ``path``.

    Segments added to it are loaded with it; statistics are added up by term.
    If neither is there, None is returned with ``missing_ok``, and searches over it find nothing.
    """
    for candidate in [path] if fallback is None else [path, fallback]:
        index = _load_segment(spark, candidate)
        if index is not None:
            segments = segments_of(spark, candidate)[1]
            merged = reduce(_merged, [_load_segment(spark, f"{candidate}/{s}") for s in segments], index)
            return _without_hot(merged) if segments and index.max_df is not None else merged
    if missing_ok:
        return None
    raise FileNotFoundError(f"no index at {path}" + (f" or {fallback}" if fallback else ""))


def _load_segment(spark: SparkSession, path: str) -> Index | None:
    info = _read_if_there(spark, f"{path}/info", schemas.INDEX_INFO)
    info = None if info is None else info.first()
    if info is None or not info["complete"]:
        return None
    index = Index(_read(spark, f"{path}/postings", schemas.POSTINGS), info["min_df"], info["max_df"],
                  _read(spark, f"{path}/term_stats", schemas.TERM_STATS), info["n_buckets"])
    if info["block_docs"] is not None:
        index = replace(index, blocks=_read(spark, f"{path}/blocks", schemas.BLOCKS), block_docs=info["block_docs"])
    if info["by_term"]:
        # Indices saved before there was that column have as many buckets there.
        buckets = info["term_buckets"] or info["n_buckets"]
        index = replace(index, by_term=(_read_by_term(spark, f"{path}/by_term", buckets),),
                        apart=spark.read.schema(schemas.POSTINGS).parquet(f"{path}/apart"))
    if info["lengths"]:
        index = replace(index, stored_lengths=spark.read.schema(schemas.LENGTHS).parquet(f"{path}/lengths"))
    return index


def _merged(index: Index, added: Index) -> Index:
    """Both as one. Statistics are grouped by bucket too, so that a choice of buckets and terms is pushed below."""
    stats = (index.stored_stats.unionByName(added.stored_stats).groupBy("term", "bucket")
             .agg(F.sum("df").alias("df"), F.sum("term_total").alias("term_total")))
    blocks = None
    if index.blocks is not None and added.blocks is not None:
        blocks = (index.blocks.unionByName(added.blocks).groupBy("term", "bucket", "block")
                  .agg(F.sum("n").alias("n"), F.max("top_tf").alias("top_tf")))
    by_term, lengths = bool(index.by_term and added.by_term), None
    if index.stored_lengths is not None and added.stored_lengths is not None:
        lengths = index.stored_lengths.unionByName(added.stored_lengths)
    return replace(index, counted=index.counted.unionByName(added.counted), stored_stats=stats, blocks=blocks,
                   by_term=index.by_term + added.by_term if by_term else (),
                   apart=index.apart.unionByName(added.apart) if by_term else None, stored_lengths=lengths)


def _without_hot(index: Index) -> Index:
    """The merged index without the postings of terms that are too frequent in all segments together."""
    hot = index.stored_stats.where(~index.is_posted()).select("term", "bucket")
    hot = F.broadcast(hot) if fits_broadcast(hot, "term") else hot
    # Joined by bucket too, so that a choice of buckets is pushed to both sides.
    return replace(index, counted=index.counted.join(hot, ["bucket", "term"], "left_anti"))


def segments_of(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """The version of an index's list of segments, 0 without one, and the folders of the segments added to it."""
    rows = _read_if_there(spark, f"{path}/manifest", T.StructType([*schemas.MANIFEST.fields, _VERSION]))
    last = None if rows is None else rows.agg(F.max("version").alias("n")).first()["n"]
    if last is None:
        return 0, []
    listed = rows.where((F.col("version") == last) & F.col("segment").isNotNull()).orderBy("place").collect()
    return last, [r["segment"] for r in listed]


def _write_manifest(spark: SparkSession, path: str, segments: list[str]) -> None:
    """The next version of the list; of two that are written at once the second fails, as its folder is there."""
    # A list without segments has one row without a name.
    rows = [(s, n) for n, s in enumerate(segments)] or [(None, 0)]
    version = segments_of(spark, path)[0] + 1
    spark.createDataFrame(rows, schemas.MANIFEST).coalesce(1).write.parquet(f"{path}/manifest/version={version}")


def append_segment(index: Index, path: str) -> None:
    """Add the documents of an unsaved index to the one saved at ``path``, whose files stay as they are.

    The documents must be new to it. They are written as a segment with the saved index's settings, and the list of
    segments gets a new version once the segment is complete. What was loaded before does not change.
    """
    spark = index.counted.sparkSession
    saved = _load_segment(spark, path)
    if saved is None:
        raise FileNotFoundError(f"no index at {path}")
    check_extensible(saved)
    if index.is_cut:
        raise ValueError("documents are added with all their terms: build their index without cuts")
    segment = f"segments/{uuid.uuid4().hex}"
    save_index(replace(index, max_df=saved.max_df), f"{path}/{segment}", saved.n_buckets, block_docs=saved.block_docs,
               by_term=bool(saved.by_term), lengths=saved.stored_lengths is not None)
    _write_manifest(spark, path, [*segments_of(spark, path)[1], segment])


def compact_index(spark: SparkSession, path: str, compacted: str) -> Index:
    """Write the index at ``path`` with all its segments as one at ``compacted``, and load that.

    The statistics are those of the segments, added up. Nothing at ``path`` changes.
    """
    index = load_index(spark, path)
    whole = replace(index, n_buckets=None, blocks=None, by_term=(), apart=None)
    save_index(whole, compacted, index.n_buckets, block_docs=index.block_docs, by_term=bool(index.by_term),
               lengths=index.stored_lengths is not None)
    return load_index(spark, compacted)


def _read_if_there(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, _BUCKET])).parquet(path)


def save_signals(path: str, pagerank: DataFrame | None = None, pageviews: DataFrame | None = None,
                 titles: DataFrame | None = None, mode: str = "error") -> None:
    """Write the signals that are given, each as its own table."""
    for name, table in (("pagerank", pagerank), ("pageviews", pageviews), ("titles", titles)):
        if table is not None:
            table.write.mode(mode).parquet(f"{path}/{name}")


def load_signal(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    """``pagerank``, ``pageviews`` or ``titles`` from a folder of signals; None if it is not there."""
    schema = {"pagerank": schemas.PAGERANK, "pageviews": schemas.PAGEVIEWS, "titles": schemas.TITLES}[name]
    return _read_if_there(spark, f"{path}/{name}", schema)
