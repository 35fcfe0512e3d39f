"""Incremental refresh and windowed counts on Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def arrivals(spark: SparkSession, path: str, schema, files: int = 4) -> DataFrame:
    """New parquet files of a folder, so many a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def event_counts(events: DataFrame, time: str = "ts", kind: str = "event_type", window: str = "1 hour", lateness: str = "1 day") -> DataFrame:
    """Rows and values by window and type; rows later than ``lateness`` are left out of windows that have closed."""
    # A time without zone is taken in the session's.
    events = events.withColumn(time, F.col(time).cast("timestamp"))
    return events.withWatermark(time, lateness).groupBy(F.window(time, window).alias("w"), kind).agg(F.count(F.lit(1)).alias("rows"), F.sum("value").alias("value")).select(F.col("w.start").alias("start"), kind, "rows", "value")


def refresh(arriving: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Applies each batch once; with an idempotent upsert a batch that is retried changes nothing."""
    return arriving.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
