"""Session windows over a stream of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def session_counts(events: DataFrame, gap: str = "12 hours", late: str = "1 day") -> DataFrame:
    """Events and values of each user's sessions; a gap of ``gap`` or more ends one, rows later than ``late`` are dropped.
    The batch pipeline's sessions end after a gap above the threshold."""
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if events.isStreaming:
        events = events.withWatermark("ts", late)
    out = events.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"), F.sum("value").alias("value"))
    return out.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "value")
