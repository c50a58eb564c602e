"""Tumbling windows and late rows over a stream; the same functions work on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling(events: DataFrame, every: str = "6 hours", late: str | None = "1 day") -> DataFrame:
    """Mean, sum and count of ``value`` by window and event type; rows later than ``late`` are dropped from a
    stream (None: the stream has its watermark already)."""
    if late is not None:
        events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if events.isStreaming and late is not None:
        events = events.withWatermark("ts", late)
    out = events.groupBy(F.window("ts", every).alias("w"), "event_type").agg(F.avg("value").alias("mean"), F.sum("value").alias("value"), F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("start"), "event_type", "mean", "value", "n")


def once(events: DataFrame, key: str = "event_id", late: str = "1 day") -> DataFrame:
    """Each key once: of a stream the first to come, its state dropped after ``late``."""
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if events.isStreaming:
        return events.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])
    return events.dropDuplicates([key])
