"""Bounded samples of labelled rows to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trawl.operators.joins import fits_broadcast
from trawl.sources.shared import write_shared

#: Rows of a label that are ranked, beyond those wanted, in standard deviations of a hash's spread.
SURPLUS = 8


def bounded_sample(labelled: DataFrame, key: str, label: str, per_label: int, most: int) -> DataFrame:
    """At most ``per_label`` keys of each label and ``most`` in all, the same at every call.

    ``labelled`` holds the key and the label only, so no text is sorted. Keys come in the order
    of a hash, and labels take turns, so that the rarest is not left out. Of a label with many keys only those
    below a bound on the hash are ranked, which leaves little more than are wanted in the task that ranks them.
    Repeated rows count once; of a key with several labels one is taken.
    """
    rows = write_shared(labelled.select(key, label).distinct(), "labelled")
    counts = rows.groupBy(label).agg(F.count("*").alias("_rows"))
    wanted = per_label + SURPLUS * (per_label ** 0.5 + 1)
    large = counts.where(F.col("_rows") > 2 * wanted).select(
        F.col(label).alias("_large"), (F.lit(wanted) / F.col("_rows") * 2.0 ** 64 - 2.0 ** 63).alias("_bound"))
    if fits_broadcast(large.select(F.col("_large").cast("string").alias("name")), "name"):
        large = F.broadcast(large)
    hashed = F.xxhash64(key)
    bounded = (rows.join(large, F.col(label) == F.col("_large"), "left")
               .where(F.col("_bound").isNull() | (hashed <= F.col("_bound"))).select(key, label))
    by_hash = Window.partitionBy(label).orderBy(hashed, key)
    ranked = bounded.withColumn("_n", F.row_number().over(by_hash)).where(F.col("_n") <= per_label)
    return (ranked.orderBy("_n", hashed, key).limit(most)
            .select(key, label).dropDuplicates([key]))
