"""Joins that stay balanced whatever the key distribution."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key carrying more work than this is split over several tasks.
SPLIT_LOAD = 4_000_000
# At most this many keys are split, which bounds the broadcast list of them.
MAX_SPLIT_KEYS = 10_000
# Rows without a key, which a left join keeps, are spread over so many parts.
NULL_PARTS = 1_000
# A table is broadcast only if it is known to take less memory than this.
BROADCAST_BYTES = 128 * 1024 * 1024
# Memory of a row in a broadcast hash table with its key and pointers, long strings apart.
ROW_BYTES = 256


def fits_broadcast(df: DataFrame, text_col: str, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the table's rows and strings are measured to stay under ``limit``."""
    size = df.agg(
        (F.count("*") * ROW_BYTES + F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).alias("size")
    ).first()["size"]
    return size <= limit


def tokens_fit_broadcast(df: DataFrame, text_col: str, copies: int = 1,
                         limit: int = BROADCAST_BYTES) -> bool:
    """Whether one row per token of ``text_col`` would stay under ``limit``."""
    return token_bytes(rows_and_bytes(df, text_col)[1], copies) <= limit


def rows_and_bytes(df: DataFrame, text_col: str) -> tuple[int, int]:
    size = df.agg(F.count("*").alias("n"), F.sum(F.octet_length(text_col)).alias("bytes")).first()
    return size["n"], size["bytes"] or 0


def token_bytes(text_bytes: int, copies: int = 1) -> int:
    """What a row per token takes at most. A token takes 3 bytes of text or more, so the text's length bounds the rows."""
    return copies * (text_bytes + text_bytes // 3 * ROW_BYTES)


def spread_join(rows: DataFrame, keys: DataFrame, on: list[str], loads: DataFrame,
                spread: list[str], how: str = "inner", split_load: int = SPLIT_LOAD) -> DataFrame:
    """Equi-join in which heavy keys are divided over several tasks.

    ``loads`` holds ``(*on, load)``, one row per key: the work the key brings.
    Keys above the cut-off get ``ceil(load / cut-off)`` parts. Each of ``rows``
    falls into one part by the hash of ``spread``, and the key's rows on the
    other side are repeated for each part. The cut-off is never below
    total / MAX_SPLIT_KEYS, so fewer than MAX_SPLIT_KEYS keys can lie above it
    and their list is safe to broadcast.
    """
    heavy = heavy_keys(loads, on, split_load)
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    # Rows with a NULL key meet nothing, so they may go anywhere.
    unmatched = reduce(Column.__or__, [F.col(c).isNull() for c in on])
    divided = (rows.join(heavy, on, "left")
               .withColumn("_part", F.pmod(F.xxhash64(*spread), F.when(unmatched, F.lit(NULL_PARTS)).otherwise(parts))
                           .cast("int")).drop("_parts"))
    repeated = (keys.join(heavy, on, "left")
                .withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts"))
    return divided.join(repeated, [*on, "_part"], how).drop("_part")


def heavy_keys(loads: DataFrame, on: list[str], split_load: int = SPLIT_LOAD) -> DataFrame:
    """``(*on, _parts)`` of the keys above the cut-off, fewer than MAX_SPLIT_KEYS, to be broadcast."""
    total = loads.agg(F.sum("load")).scalar()
    cut = F.greatest(F.lit(split_load), F.ceil(total / MAX_SPLIT_KEYS))
    return F.broadcast(loads.where(F.col("load") > cut)
                       .select(*on, F.ceil(F.col("load") / cut).cast("int").alias("_parts")))


def lookup_join(rows: DataFrame, table: DataFrame, on: str, spread: list[str], how: str = "inner") -> DataFrame:
    """Join to a table with one row per key, when any share of ``rows`` may have the same key."""
    loads = rows.where(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias("load"))
    return spread_join(rows, table, [on], loads, spread, how)
