"""Streaming extension: hourly volume and bursts of authors over late-tolerant event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_stream(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def volume(events: DataFrame, key: str, late: str = "2 hours", width: str = "60 minutes") -> DataFrame:
    """(window_start, key, mentions): events carry posted_at."""
    windows = events.withWatermark("posted_at", late).groupBy(F.window("posted_at", width), key)
    return windows.agg(F.count(F.lit(1)).alias("mentions")).select(F.col("window.start").alias("window_start"), key, "mentions")


def bursts(events: DataFrame, least: int, late: str = "2 hours", width: str = "60 minutes", step: str = "15 minutes") -> DataFrame:
    """Authors with at least ``least`` mentions in a sliding hour."""
    windows = events.withWatermark("posted_at", late).groupBy(F.window("posted_at", width, step), "author_id")
    return windows.agg(F.count(F.lit(1)).alias("mentions")).where(F.col("mentions") >= least).select(F.col("window.start").alias("window_start"), "author_id", "mentions")
