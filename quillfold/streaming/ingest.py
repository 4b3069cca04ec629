"""Streams, an extension: ingest of files as they come, and windows over run events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_documents(stream: DataFrame, ts: str = "ts", hash_col: str = "file_hash", late: str = "1 day") -> DataFrame:
    """Documents whose hash wasn't seen within the watermark; state is bounded by it."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([hash_col])


def event_windows(events: DataFrame, size: str = "1 hour", slide: str | None = None, late: str = "1 hour", by: str = "event_type") -> DataFrame:
    """Counts and sums per (sliding) window; works on tables and streams alike."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    return rows.groupBy(w.alias("w"), by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), by, "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
