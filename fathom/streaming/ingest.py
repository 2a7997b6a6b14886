"""Streaming ingestion: an extension, built on Structured Streaming.

Submissions that arrive as files pass the same batch plans: each micro-batch is checked and
appended by ``foreachBatch``; ``availableNow`` drains what is there and stops. Registry state
is the latest record of each key, kept by version, so replays change nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery


def stream_json(spark: SparkSession, path: str, schema: str, files_a_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).json(path)


def stream_parquet(spark: SparkSession, path: str, schema, files_a_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)


def drain(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run ``apply(batch, id)`` on all that has arrived, then stop; restarts go on from the checkpoint."""
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(records: DataFrame, key: str, version: str) -> DataFrame:
    """The highest version of each key."""
    w = Window.partitionBy(key).orderBy(F.col(version).desc())
    return records.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def windowed_counts(events: DataFrame, time: str, key: str, width: str, late: str, slide: str | None = None) -> DataFrame:
    """Events by key and time window, late ones up to ``late`` after the latest seen."""
    w = F.window(time, width, slide) if slide else F.window(time, width)
    return (events.withWatermark(time, late).groupBy(w, key).agg(F.count("*").alias("n"))
            .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), key, "n"))
