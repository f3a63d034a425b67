"""Connected components of a graph of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trawl.operators.joins import spread_join
from trawl.sources.shared import write_shared


def _gathered(edges: DataFrame) -> DataFrame:
    """``edges (u, v)``, u > v, with the lower neighbours of each u, and u, moved to the least of them."""
    least = edges.select("u", "v", F.min("v").over(Window.partitionBy("u")).alias("m"))
    moved = least.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
    return moved.select("e.*").where("u > v").distinct()


def _shortened(edges: DataFrame) -> DataFrame:
    """Every edge moved from its lower end to the least lower neighbour of that, if there is one.

    Very many edges may have the same lower end, so those are split.
    """
    parents = edges.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m"))
    loads = edges.groupBy("v").agg(F.count("*").alias("load"))
    joined = spread_join(edges, parents, ["v"], loads, ["u"], "left")
    return joined.select("u", F.coalesce("m", "v").alias("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` of ``links (a, b)``: every id in a link, with the least id it is connected to.

    Both steps keep what is connected. A round halves the longest path to the least id. Rounds
    end when nothing changes; each is written to the shared folder.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    edges, state = write_shared(_gathered(edges), "edges"), None
    while True:
        edges = write_shared(_gathered(_shortened(edges)), "edges")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % (1 << 30)).alias("sum")).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
