"""Reading tables and settling intermediate results in the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Makes Spark delete the shuffle files of a query when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a folder of our own only where that is unset and driver and executors are one machine."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("convolens.work.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = "file://" + os.path.join(tempfile.gettempdir(), f"convolens-{uuid.uuid4().hex}")
        spark.conf.set("convolens.work.dir", folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/convolens/{uuid.uuid4().hex}/{name}"


def settle(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write as Parquet and read back, so that loops don't grow lineage and lost executors cost a re-read.

    Shuffle files of the write go when it ends."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        spark.conf.set(_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table._settled_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete settled tables that nothing reads any more."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table._settled_at)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path.getParent(), True)
