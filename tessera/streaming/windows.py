"""Event-time windows over streams: extras beyond batch queries, on Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling(events: DataFrame, time: str, size: str, late: str, *keys: str) -> DataFrame:
    """Counts and sums by window and key; rows later than ``late`` are dropped and their state freed."""
    marked = events.withWatermark(time, late) if events.isStreaming else events
    grouped = marked.groupBy(F.window(time, size), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return grouped.select(F.col("window.start").alias("window_start"), *keys, "n", "total")


def sessions(events: DataFrame, time: str, gap: str, late: str, *keys: str) -> DataFrame:
    """Session windows: a gap ends a session."""
    marked = events.withWatermark(time, late) if events.isStreaming else events
    grouped = marked.groupBy(F.session_window(time, gap), *keys).agg(F.count("*").alias("n"))
    return grouped.select(F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), *keys, "n")
