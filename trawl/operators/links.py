"""The link graph: edges, vertices and PageRank."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.operators.joins import MAX_SPLIT_KEYS, SPLIT_LOAD
from trawl.sources.shared import write_shared

RESET = 0.15
ITERATIONS = 10
CHECKPOINT_EVERY = 5


def links_of(corpus: DataFrame) -> DataFrame:
    """``(src, dst, text)``, one row per link; a NULL array holds no links."""
    return (corpus.select(F.col("id").alias("src"), F.explode("anchor_text").alias("link"))
            .select("src", F.col("link.id").alias("dst"), F.col("link.text").alias("text")))


def link_edges(links: DataFrame) -> DataFrame:
    """Distinct ``(src, dst)``; self-links stay, links without a source or target do not count."""
    return links.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL").distinct()


def link_vertices(corpus: DataFrame) -> DataFrame:
    """Distinct source documents, with the id again as their ``title`` attribute."""
    return corpus.select("id").distinct().withColumn("title", F.col("id"))


def pagerank(edges: DataFrame, docs: DataFrame, reset: float = RESET,
             iterations: int = ITERATIONS, checkpoint_every: int = CHECKPOINT_EVERY,
             all_vertices: bool = False) -> DataFrame:
    """PageRank of the documents ``docs (id)`` over distinct ``edges (src, dst)``.

    Every end of an edge takes part; only documents are returned, or all vertices on
    request. Ranks start at 1, follow ``reset + (1 - reset) * sum(rank / outdegree)`` and
    are scaled to mean 1 after the last round.

    Edges and vertices are written once. Within a stretch of ``checkpoint_every``
    rounds the shuffled edges and vertices are the same exchange, which Spark
    reuses, so a round moves only ranks and pre-summed shares. A source with very
    many links is split into parts by target, and its rank is sent to each part. Between stretches
    ranks are written. Edges with a NULL end are left out.
    """
    vertices, divided = _graph(edges, docs)
    ranks = vertices.withColumn("rank", F.lit(1.0))
    for step in range(1, iterations + 1):
        shares = (ranks.where("out > 0")
                  .select(F.col("id").alias("src"), (F.col("rank") / F.col("out")).alias("share"),
                          F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")))
        received = (divided.join(shares, ["src", "part"])
                    .groupBy(F.col("dst").alias("id")).agg(F.sum("share").alias("received")))
        ranks = (vertices.join(received, "id", "left")
                 .select("id", "doc", "out", "parts",
                         (reset + (1 - reset) * F.coalesce("received", F.lit(0.0))).alias("rank")))
        if step % checkpoint_every == 0 or step == iterations:
            ranks = write_shared(ranks, "ranks")
    scale = ranks.agg(F.count("*") / F.sum("rank")).scalar()
    if not all_vertices:
        ranks = ranks.where("doc = 1")
    return ranks.select("id", (F.col("rank") * scale).alias("pagerank"))


def _graph(edges: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(id, doc, out, parts)`` of all vertices, and ``(src, dst, part)``; both are written once."""
    one, none = F.lit(1), F.lit(0)
    edges = write_shared(edges.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL"), "edges")
    ends = (docs.select("id", one.alias("doc"), none.alias("out"))
            .unionByName(edges.select(F.col("src").alias("id"), none.alias("doc"), one.alias("out")))
            .unionByName(edges.select(F.col("dst").alias("id"), none.alias("doc"), none.alias("out")))
            .groupBy("id").agg(F.max("doc").alias("doc"), F.sum("out").alias("out")))
    # At most MAX_SPLIT_KEYS sources can lie above the cut, see spread_join.
    cut = F.greatest(F.lit(SPLIT_LOAD), F.ceil(edges.agg(F.count("*")).scalar() / MAX_SPLIT_KEYS))
    vertices = write_shared(
        ends.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("out") / cut)).cast("int")), "vertices")
    heavy = F.broadcast(vertices.where("parts > 1").select(F.col("id").alias("src"), "parts"))
    divided = (edges.join(heavy, "src", "left")
               .select("src", "dst", F.pmod(F.xxhash64("dst"), F.coalesce("parts", F.lit(1)))
                       .cast("int").alias("part")))
    return vertices, divided


def update_pagerank(edges: DataFrame, docs: DataFrame, earlier: DataFrame, reset: float = RESET,
                    tolerance: float = 1e-3, all_vertices: bool = False) -> tuple[DataFrame, int]:
    """PageRank of a graph that has changed, from ``earlier (id, pagerank)``, and the number of rounds it took.

    The residual of a vertex is what the recurrence would change its rank by. A round adds the residuals of more than
    ``tolerance * reset`` to their ranks and passes them on along the links; the others wait until more has come
    together. When none is left, ranks differ from the recurrence's limit by ``tolerance`` in the mean at most, before they are
    scaled to mean 1. Where little has changed, few vertices have anything to pass on, and rounds are few. New
    vertices start at 1; those that are gone do not count. Of repeated or null earlier ranks of a vertex the
    largest counts. What a round leaves is written to the shared folder.
    """
    vertices, divided = _graph(edges, docs)
    start = earlier.groupBy("id").agg(F.max("pagerank").alias("rank"))
    state = write_shared(vertices.join(start, "id", "left").withColumn("rank", F.coalesce("rank", F.lit(1.0))), "ranks")
    # Earlier ranks were scaled; taken times this factor, their residuals add up to 0.
    kept = F.sum("rank") - (1 - reset) * F.sum(F.when(F.col("out") > 0, F.col("rank")).otherwise(0.0))
    state = state.withColumn("rank", F.col("rank") * state.agg(reset * F.count("*") / kept).scalar())

    def received(amount: str, senders: DataFrame) -> DataFrame:
        shares = (senders.where("out > 0")
                  .select(F.col("id").alias("src"), (F.col(amount) / F.col("out")).alias("share"),
                          F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")))
        return (divided.join(shares, ["src", "part"]).groupBy(F.col("dst").alias("id"))
                .agg(((1 - reset) * F.sum("share")).alias("received")))

    came = F.coalesce("received", F.lit(0.0))
    state = write_shared(state.join(received("rank", state), "id", "left")
                         .withColumn("residual", reset + came - F.col("rank")).drop("received"), "ranks")
    passes, rounds = F.abs("residual") > tolerance * reset, 0
    while not state.where(passes).isEmpty():
        moved = state.join(received("residual", state.where(passes)), "id", "left")
        state = write_shared(moved.select(
            "id", "doc", "out", "parts", F.when(passes, F.col("rank") + F.col("residual")).otherwise(F.col("rank")).alias("rank"),
            (F.when(passes, 0.0).otherwise(F.col("residual")) + came).alias("residual")), "ranks")
        rounds += 1
    scale = state.agg(F.count("*") / F.sum("rank")).scalar()
    ranks = state if all_vertices else state.where("doc = 1")
    return ranks.select("id", (F.col("rank") * scale).alias("pagerank")), rounds
