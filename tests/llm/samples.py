"""Small tables with every odd case."""

import random

from pyspark.sql import functions as F

WORDS = ("ere und the la river stone is of and to house while der que por green for they under before a in on we "
         "little cannot among").split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", "s", "ing", ".", ",", "\n"]) for _ in range(n))


def odd_texts():
    """``(doc_id, text)``: nulls, empty and blank texts, a long one, repeated rows, a null id, copies, odd signs."""
    return [(1, prose(1, 120)), (2, None), (3, ""), (4, " \n\t \x0b "), (5, prose(5, 30_000)), (6, prose(1, 120)),
            (7, prose(7, 40)), (7, prose(7, 40)), (None, prose(8, 60)), (None, None), (9, "one"), (10, "12345 !!! 777"),
            (11, "don't STOP ÉCOLE straße 日本語 İstanbul a\xa0b\x1cc\x85d é é"), (12, "x" * 5000),
            (13, "la la la " * 60), (-3, prose(1, 119)), (14, "<|endoftext|> a<|startoftext|>b")]


def documents(spark, rows=None, lang="en"):
    """Such a table with further columns whose names the operators use themselves."""
    rows = odd_texts() if rows is None else rows
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    clash = ["score", "lang_pred", "accepted", "predicted", "bucket", "key", "id", "digest", "n_words", "matches", "spans",
             "label", "_found", "crc", "ranges", "rank"]
    return table.select("doc_id", "text", F.lit(lang).alias("lang"), *[F.lit(n).alias(c) for n, c in enumerate(clash)])


def no_documents(spark):
    return documents(spark, [])
