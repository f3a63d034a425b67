"""A Merkle manifest of a table: trees kept as append-only logs in the order in which nodes complete."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.common import read, remainder
from trawl.operators.joins import fits_broadcast, lookup_join
from trawl.sources.shared import write_shared

#: Levels that one builder completes: it takes 2^10 nodes.
LEVELS = 10
#: A partition's rows are numbered in so many low bits by ``monotonically_increasing_id``.
ROW_BITS = 33


# --- a tree's log ---------------------------------------------------------------------------

def joined(*digests: bytes) -> bytes:
    """Hex digest of hex digests, one after the other."""
    return hashlib.sha256(b"".join(digests)).hexdigest().encode()


def height(leaves: int) -> int:
    return (leaves - 1).bit_length()


def position(index: np.ndarray, level: int, leaves: int) -> np.ndarray:
    """Place of nodes in the log of a tree of so many leaves, by their index on a level.

    Before a node's subtree, which begins at leaf ``index << level``, the log holds all nodes over
    leaves further left: floor(first / 2^i) of each level i, twice the first leaf less its number of binary ones in all.
    The subtree has ceil(own / 2^i) nodes of each level up to the node's, and the node is its last.
    """
    first = index << level
    own = np.minimum(1 << level, leaves - first)
    subtree = sum(((own - 1) >> i) + 1 for i in range(level + 1))
    return 2 * first - np.bitwise_count(first) + subtree - 1


def completed(nodes: list[bytes], first: int, low: int, high: int, leaves: int) -> Iterator[tuple[int, int, bytes]]:
    """``(level, index, digest)`` of all nodes up to level ``high`` over consecutive nodes of level ``low``, as they complete.

    ``first`` is the index of the first, the start of an aligned block. A node without a sibling, the last of its
    level, is hashed alone.
    """
    waiting: dict[int, bytes] = {}
    for index, digest in enumerate(nodes, first):
        level = low
        yield level, index, digest
        while level < high:
            if index & 1:
                digest = joined(waiting.pop(level), digest)
            elif index == (leaves - 1) >> level:
                digest = joined(digest)
            else:
                waiting[level] = digest
                break
            level, index = level + 1, index >> 1
            yield level, index, digest


# --- the logs of many trees -----------------------------------------------------------------

LOG = "tree string, leaves bigint, level int, index bigint, first bigint, last bigint, nodes binary, top string"
SIBLINGS = "array<struct<left:boolean,digest:string>>"


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``rank``, their place in their ``tree`` by ``order`` from 0, and ``leaves``, the tree's size.

    Rows are sorted by range, so a tree may span any number of partitions, and numbered within them; the first
    number of each tree in each partition is what is added up. Rows equal in ``order`` may share no key, so they are
    told apart by where they were read.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    key = ["tree", *order, "_tie"]
    numbered = write_shared(
        tied.repartitionByRange(*key).sortWithinPartitions(*key).drop("_tie")
        .withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", ROW_BITS)), "sorted")
    runs = numbered.groupBy("tree", "_part").agg(F.min("_at").alias("_start"), F.count("*").alias("_n"))
    of_tree = Window.partitionBy("tree")
    before = F.sum("_n").over(of_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = write_shared(runs.select("tree", "_part", (F.coalesce(before, F.lit(0)) - F.col("_start")).alias("_shift"),
                                      F.sum("_n").over(of_tree).alias("leaves")), "starts")
    # One row per partition and tree, few unless trees are very many.
    starts = F.broadcast(starts) if fits_broadcast(starts, "tree") else starts
    return (numbered.join(starts, ["tree", "_part"]).withColumn("rank", F.col("_at") + F.col("_shift"))
            .drop("_at", "_part", "_shift"))


def _low_builder(levels: int):
    def build(key: tuple, table: pa.Table) -> pa.Table:
        """One block of leaves: its nodes in completion order, which lie side by side in the log."""
        tree, block = (k.as_py() for k in key)
        leaves = table.column("leaves")[0].as_py()
        order = np.argsort(table.column("rank").to_numpy())
        digests = [d.encode() for d in table.column("digest").take(pa.array(order)).to_pylist()]
        high = min(levels, height(leaves))
        nodes = list(completed(digests, block << levels, 0, high, leaves))
        at = int(position(np.array([block << levels]), 0, leaves)[0])
        blob = b"".join(bytes.fromhex(d.decode()) for _, _, d in nodes)
        return _log_rows([(tree, leaves, high, block, at, at + len(nodes) - 1, blob, nodes[-1][2].decode())])
    return build


def _high_builder(low: int, levels: int):
    def build(key: tuple, table: pa.Table) -> pa.Table:
        """One block of nodes of level ``low``: the nodes above them, each with its own place."""
        tree, block = (k.as_py() for k in key)
        leaves = table.column("leaves")[0].as_py()
        order = np.argsort(table.column("index").to_numpy())
        tops = [d.encode() for d in table.column("top").take(pa.array(order)).to_pylist()]
        rows = []
        for level, index, digest in completed(tops, block << levels, low, min(low + levels, height(leaves)), leaves):
            if level > low:
                at = int(position(np.array([index]), level, leaves)[0])
                rows.append((tree, leaves, level, index, at, at, bytes.fromhex(digest.decode()), digest.decode()))
        return _log_rows(rows)
    return build


def _log_rows(rows: list[tuple]) -> pa.Table:
    types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
    names = [c.split()[0] for c in LOG.split(", ")]
    return pa.table([pa.array(v, t) for v, t in zip(list(zip(*rows)) or [()] * len(types), types)], names=names)


@dataclass(frozen=True)
class Forest:
    """Trees over ``leaves (tree, leaves, rank, digest, ...)`` and their ``log``.

    A row of the log is a run of nodes at the places ``first`` to ``last`` of a tree's log, 32 bytes each, with the last
    one, ``top``, on ``level`` at ``index``. Runs of level ``levels`` or of whole small trees hold the nodes of a
    block of leaves, all others one node.
    """

    leaves: DataFrame
    log: DataFrame
    levels: int

    @property
    def roots(self) -> DataFrame:
        """``(tree, root)``"""
        top = F.expr("index = 0 AND shiftleft(1L, level) >= leaves")
        return self.log.where(top).select("tree", F.col("top").alias("root"))

    @property
    def blocks(self) -> DataFrame:
        """Runs over leaves, with ``block``, their number in the tree."""
        return self.log.where(F.col("level") <= self.levels).withColumnRenamed("index", "block")

    def upper_siblings(self) -> DataFrame:
        """``(tree, block, upper)``: of each block the siblings on its way from its top to the root, lowest first."""
        place = """2 * start - bit_count(start)
            + aggregate(sequence(0, at), 0L, (n, i) -> n + shiftright(own - 1, i) + 1) - 1"""
        steps = (self.blocks.select("tree", "block", "leaves", F.posexplode(F.expr(
                     f"IF(shiftleft(1L, {self.levels}) < leaves, "
                     f"filter(sequence({self.levels}, 63), k -> k < 63 AND shiftleft(1L, k) < leaves), array())"))
                     .alias("step", "at"))
                 .withColumn("index", F.expr(f"shiftright(block, at - {self.levels})"))
                 .withColumn("sibling", F.expr("index ^ 1L"))
                 .withColumn("start", F.expr("shiftleft(sibling, at)"))
                 .withColumn("own", F.expr("least(shiftleft(1L, at), leaves - start)"))
                 # The last node of a level may have no sibling.
                 .withColumn("place", F.when(F.expr("own > 0"), F.concat(F.expr(place), F.lit(":"), F.col("tree")))))
        nodes = self.log.select(F.concat("last", F.lit(":"), "tree").alias("place"), F.col("top").alias("digest"))
        # A node near the root is the sibling of very many.
        found = lookup_join(steps, nodes, "place", ["tree", "block"], "left")
        entry = F.struct("step", (F.col("index") % 2 == 1).alias("left"), "digest")
        gathered = found.groupBy("tree", "block").agg(F.array_sort(F.collect_list(entry)).alias("steps"))
        upper = F.transform("steps", lambda s: F.struct(s["left"].alias("left"), s["digest"].alias("digest")))
        return gathered.select("tree", "block", upper.alias("upper"))

    def proofs(self, carried: list[str], of_tree: DataFrame | None = None) -> DataFrame:
        """The ``carried`` columns of each leaf with ``tree``, ``digest`` and ``siblings``, those on its way to the root.

        A sibling is left or right of the way and null where a node is hashed alone. ``of_tree (tree, beyond, ...)``
        adds its ``beyond`` siblings to those of each leaf in the tree, and its other columns.
        """
        levels = self.levels
        blocks = (self.blocks.select("tree", "block", "leaves", "first", "nodes")
                  .join(self.upper_siblings(), ["tree", "block"], "left")
                  .withColumn("upper", F.coalesce("upper", F.array().cast(SIBLINGS))))
        added: list[str] = []
        if of_tree is not None:
            added = [c for c in of_tree.columns if c not in ("tree", "beyond")]
            blocks = (lookup_join(blocks, of_tree, "tree", ["block"])
                      .withColumn("upper", F.concat("upper", "beyond")).drop("beyond"))
        own = self.leaves.select("tree", F.expr(f"shiftright(rank, {levels})").alias("block"), "rank", "digest", *carried)
        schema = own.select("tree", "digest", *carried, *[F.lit(None).cast("string").alias(c) for c in added],
                            F.lit(None).cast(SIBLINGS).alias("siblings")).schema

        def extract(key: tuple, leaf: pa.Table, block: pa.Table) -> pa.Table:
            row = {c: block.column(c)[0].as_py() for c in ["block", "leaves", "first", "nodes", "upper", *added]}
            rank, leaves = leaf.column("rank").to_numpy(), row["leaves"]
            raw, at, left, there = row["nodes"].hex(), [], [], []
            known = [raw[i:i + 64] for i in range(0, len(raw), 64)]
            for level in range(min(levels, height(leaves))):
                index = rank >> level
                there.append(index ^ 1 <= (leaves - 1) >> level)
                at.append(np.where(there[-1], position(np.where(there[-1], index ^ 1, 0), level, leaves) - row["first"], 0))
                left.append(index & 1 == 1)
            for n, s in enumerate(row["upper"], len(known)):
                there.append(np.full(len(rank), s["digest"] is not None))
                at.append(np.full(len(rank), n))
                left.append(np.full(len(rank), s["left"]))
            known += [s["digest"] for s in row["upper"]]
            steps = len(at)
            flat = lambda parts, kind: np.array(parts, kind).reshape(steps, len(rank)).T.ravel()
            digests = pa.array(known, pa.string()).take(pa.array(flat(at, np.int64), mask=~flat(there, bool)))
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(rank) + 1) * steps, pa.int32()),
                pa.StructArray.from_arrays([pa.array(flat(left, bool)), digests], names=["left", "digest"]))
            more = {c: pa.array([row[c]] * len(rank), pa.string()) for c in added}
            return pa.table({"tree": leaf.column("tree"), "digest": leaf.column("digest"),
                             **{c: leaf.column(c) for c in carried}, **more, "siblings": lists})

        keys = ["tree", "block"]
        return own.groupBy(*keys).cogroup(blocks.groupBy(*keys)).applyInArrow(extract, schema)


def build_forest(rows: DataFrame, order: list[str], levels: int = LEVELS) -> Forest:
    """A tree over the rows of each ``tree``, by ``order``; ``digest`` is a row's leaf, and a tree's number of rows is free.

    Builders take aligned blocks of 2^levels nodes. The first write the log of a block of leaves, those after
    them the nodes above 2^levels tops, until each tree has one node left. ``tree`` must not be null; empty
    rows give no trees.
    """
    leaves = write_shared(ranked(rows, order), "leaves")
    block = F.expr(f"shiftright(rank, {levels})").alias("block")
    built = (leaves.select("tree", block, "leaves", "rank", "digest").groupBy("tree", "block")
             .applyInArrow(_low_builder(levels), LOG))
    log, low = write_shared(built, "log"), levels
    largest = leaves.agg(F.max("leaves").alias("n")).first()["n"] or 0
    written = log
    while largest > 1 << low:
        tops = (written.where((F.col("level") == low) & (F.col("leaves") > 1 << low))
                .select("tree", F.expr(f"shiftright(index, {levels})").alias("block"), "leaves", "index", "top"))
        written = write_shared(tops.groupBy("tree", "block").applyInArrow(_high_builder(low, levels), LOG), "log")
        log, low = log.unionByName(written), low + levels
    return Forest(leaves, log, levels)


# --- a table's manifest ---------------------------------------------------------------------

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def field(value: Column) -> Column:
    """A value as it goes into a leaf: its length in bytes, a colon and its text, or ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def tree_name(group: Column) -> Column:
    """A name for each group that is never null and sorts as the groups do, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


@dataclass(frozen=True)
class Manifest:
    """The trees of all groups, and the tree over their roots."""

    groups: Forest
    whole: Forest

    def root(self) -> DataFrame:
        """``(root)``, no row for an empty table."""
        return self.whole.roots.select("root")

    def proofs(self, carried: list[str]) -> DataFrame:
        """``carried`` columns of each row with its ``digest``, ``subroot``, ``root`` and ``siblings`` up to the root."""
        above = self.whole.proofs(["name"]).select(
            F.col("name").alias("tree"), F.col("digest").alias("subroot"), F.col("siblings").alias("beyond"))
        above = above.withColumn("root", self.root().scalar())
        return self.groups.proofs(carried, write_shared(above, "above")).drop("tree")


def manifest(rows: DataFrame, order: list[str], levels: int = LEVELS) -> Manifest:
    """Of ``rows (tree, digest, *order, ...)``, one tree a group and one over the groups' roots in order of name."""
    groups = build_forest(rows, [*order, "digest"], levels)
    roots = groups.roots.select(F.lit("").alias("tree"), F.col("root").alias("digest"), F.col("tree").alias("name"))
    return Manifest(groups, build_forest(roots, ["name"], levels))


def document_manifest(docs: DataFrame, fields: list[str] = FIELDS, group: str = "lang", order: str = "doc_id",
                      levels: int = LEVELS, extra: dict[str, Column] | None = None) -> Manifest:
    """The manifest of a table: leaves over ``fields`` in order of ``order``, a tree for each ``group``.

    A null in any field goes into its leaf as ``-``; rows without a group are a group of their own, the first, and rows
    without an ``order`` come first in theirs. Rows with equal order come in the order of their leaves, and equal
    rows are leaves of their own. Empty and very long texts are values like others, and only digests are moved.
    Columns that are not fields do not count; ``extra`` columns are carried along. An empty table has no trees and no root.
    """
    digests = docs.select(tree_name(F.col(group)).alias("tree"), F.col(order).alias("_order"),
                          leaf_digest([F.col(c) for c in fields]).alias("digest"),
                          *[c.alias(n) for n, c in (extra or {}).items()])
    # Written first, since sorting by range reads its input twice.
    return manifest(write_shared(digests, "digests"), ["_order"], levels)


def fold(leaf: Column, siblings: Column) -> Column:
    """The root that follows from a leaf and the siblings on its way."""
    return F.aggregate(siblings, leaf, lambda node, s: F.sha2(F.when(s["digest"].isNull(), node)
                       .when(s["left"], F.concat(s["digest"], node)).otherwise(F.concat(node, s["digest"])), 256))


def op13_manifest(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    changed = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    tampered = F.when((remainder("doc_id", 7) == 0) & F.col("n_chars").isNotNull(), leaf_digest(changed))
    made = document_manifest(docs, extra={"doc_id": F.col("doc_id"), "tampered": tampered})
    proofs = made.proofs(["doc_id", "tampered"])
    folded = proofs.withColumn("folded_root", fold(F.coalesce("tampered", "digest"), F.col("siblings")))
    listed = F.concat_ws("", F.transform("siblings", lambda s: s["digest"]))
    return folded.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", F.sha2(listed, 256).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
