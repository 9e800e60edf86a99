"""Event-time windows, as batch and as Structured Streaming: one plan for both."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling(events: DataFrame, width: str = "1 day", late: str | None = None) -> DataFrame:
    """window_start, event_type, n, users of each window; late: the watermark of a stream."""
    rows = events.withWatermark("ts", late) if late and events.isStreaming else events
    counted = rows.groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).alias("value"))
    return counted.select(F.col("window.start").alias("window_start"), "event_type", "n", "value")


def sessions(events: DataFrame, gap: str = "6 hours", late: str | None = None) -> DataFrame:
    """user_id, session_start, session_end (of the last event), n of each run of events with smaller gaps."""
    rows = events.withWatermark("ts", late) if late and events.isStreaming else events
    found = rows.groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last"))
    return found.select("user_id", F.col("session_window.start").alias("session_start"), F.col("last").alias("session_end"), "n")
