"""Per-document signals: page views, titles, maxima and ordered look-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.operators.joins import lookup_join

# Fixed value: an integer with underscores between its digits, which counts as an integer too.
GROUPED_PATTERN = r"^\s*[+-]?[0-9]+(_[0-9]+)+\s*$"


def parse_pageviews(lines: DataFrame) -> DataFrame:
    """``(id, views)`` from lines whose first and third space-separated fields are integers.

    Every other line is dropped. The ``position`` of lines that have one is kept.
    """
    place = [c for c in ("position",) if c in lines.columns]
    fields = lines.select(F.split("value", " ").alias("f"), *place)
    pair = F.struct(_integer(1).alias("id"), _integer(3).alias("views"))
    # As a generator the check stays above the split; as a filter it would be pushed below and
    # repeat the split for every reference to a field.
    whole = F.filter(F.array(pair), lambda p: p["id"].isNotNull() & p["views"].isNotNull())
    return (fields.select(F.explode(whole).alias("p"), *place).select("p.id", "p.views", *place)
            .where(F.col("id").isNotNull() & F.col("views").isNotNull()))


def _integer(position: int) -> Column:
    """The field as a number; the slower pattern is tried only where a plain cast fails."""
    field = F.try_element_at("f", F.lit(position))
    grouped = F.when(field.rlike(GROUPED_PATTERN), F.replace(field, F.lit("_"), F.lit("")))
    return F.coalesce(field.try_cast("bigint"), grouped.try_cast("bigint"))


class NoPositions(KeyError, ValueError):
    """The last of several lines was asked for, and the column ``position`` that tells it is missing."""


def pageview_map(pairs: DataFrame, on_duplicate: str = "sum") -> DataFrame:
    """One row per id; values of a repeated id are summed, or the largest or the last is kept.

    The last is that of the largest ``position``, which lines read with positions have. Of equal positions, as
    rows that were copied have, the larger value counts.
    """
    if on_duplicate == "last":
        if "position" not in pairs.columns:
            raise NoPositions("the last of several lines is known only if they are read with positions")
        last = F.max(F.struct("position", "views"))
        return pairs.groupBy("id").agg(last.alias("l")).select("id", "l.views")
    merge = {"sum": F.sum, "max": F.max}[on_duplicate]
    return pairs.groupBy("id").agg(merge("views").alias("views"))


def title_map(corpus: DataFrame) -> DataFrame:
    """One title per id; of several the first in order."""
    return corpus.groupBy("id").agg(F.min("title").alias("title"))


def signal_max(signal: DataFrame, value: str) -> DataFrame:
    """One row ``(max_value)``; 0 for an empty signal."""
    return signal.agg(F.coalesce(F.max(value), F.lit(0)).alias("max_value"))


def top_of(signal: DataFrame, value: str) -> Column:
    """The same as a scalar subquery."""
    return signal_max(signal, value).scalar()


def lookup_pagerank(ids: DataFrame, pagerank: DataFrame) -> DataFrame:
    """``(pos, id, pagerank)`` for ``ids (pos, id)``: repeats kept, 0.0 if unknown, ordered by pos."""
    found = lookup_join(ids, pagerank, "id", ["pos"], "left")
    return found.select("pos", "id", F.coalesce("pagerank", F.lit(0.0)).alias("pagerank")).orderBy("pos")


def lookup_pageviews(ids: DataFrame, pageviews: DataFrame) -> DataFrame:
    """``(pos, id, views)`` for ``ids (pos, id)``: repeats kept, 0 if unknown, ordered by pos."""
    found = lookup_join(ids, pageviews, "id", ["pos"], "left")
    return found.select("pos", "id", F.coalesce("views", F.lit(0)).cast("bigint").alias("views")).orderBy("pos")
