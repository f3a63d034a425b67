"""A training corpus from raw documents, in five stages.

Every stage takes whole tables, keeps all columns as they are but those it names, whatever further columns there are,
gives no rows for none, and treats null texts as texts without words: they pass all filters. Equal rows pass or go together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.llm import toxicity as tox
from trawl.llm.common import read
from trawl.llm.decontamination import decontaminate
from trawl.llm.near_duplicates import without_near_duplicates
from trawl.llm.packing import pack
from trawl.llm.secrets import redact
from trawl.sources.shared import write_shared


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine, fitted to ``labels``, does not predict as toxic.

    Empty and null texts are scored like a text without any known term. Without labels nothing goes.
    """
    model = tox.train_on_folds(docs, read(spark, sf_dir, "labels"))
    return tox.score(docs.select(F.struct("*").alias("row"), F.col("text")), model).where("predicted = 0").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near duplicates (five words, 80 per cent), and all others.

    Rows of the least id all stay, also repeated ones. Rows without an id or without words are near to nothing and stay.
    """
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten consecutive words of a text in ``benchmark``; texts without words are no benchmark."""
    return decontaminate(docs, read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced by the kind of secret; ``n_chars`` is null for a null text."""
    return redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents that are left, in sequences of 4096 ids; a text without tokens is its end mark alone."""
    return pack(docs)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", secrets), ("packing", packing)]

#: Toxicity is a trained model, so SQL cannot give these rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_shared(stage(spark, docs, sf_dir), name)
    return docs
