"""Structured Streaming forms of the event operators. The engine's model is batch; these are an extension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def event_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours", time: str = "ts") -> DataFrame:
    """Counts and sums per type in tumbling windows; rows later than the watermark are dropped."""
    d = events.withWatermark(time, late) if events.isStreaming else events
    return d.groupBy(F.window(time, width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "events", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours", time: str = "ts") -> DataFrame:
    """Sessions per user that end after a gap."""
    d = events.withWatermark(time, late) if events.isStreaming else events
    return d.groupBy(F.session_window(time, gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("events")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "events")


def first_seen(events: DataFrame, keys: list[str], late: str = "2 hours", time: str = "ts") -> DataFrame:
    """Keep-first of each key within the watermark."""
    d = events.withWatermark(time, late) if events.isStreaming else events
    return d.dropDuplicatesWithinWatermark(keys) if events.isStreaming else d.dropDuplicates(keys)
