"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Folders made for sessions on one machine that name none, by application.
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir`` or ``setCheckpointDir``.

    A session on one machine that names none gets a temporary folder, which its settings do
    not show. On a cluster that is an error, as other machines would not see the folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    master = context.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("name a folder that all machines share in spark.checkpoint.dir")
    return _LOCAL.setdefault(context.applicationId, tempfile.mkdtemp(prefix="trawl-"))


def run_folder(spark: SparkSession) -> str:
    """Where this application's intermediate tables are; see ``clear_run_folder``."""
    return f"{shared_folder(spark).rstrip('/')}/trawl/{spark.sparkContext.applicationId}"


def clear_run_folder(spark: SparkSession) -> bool:
    """Delete this application's intermediate tables, once no result is read any more; whether there were any."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def write_shared(df: DataFrame, name: str) -> DataFrame:
    """The table, computed once, written to the shared folder and read back."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
