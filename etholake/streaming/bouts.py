"""Bouts of a running stream: sessions of equal labels that end with a gap or a change, and their counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def label_sessions(events: DataFrame, time: str = "ts", label: str = "syllable", gap: str = "10 minutes", delay: str = "30 minutes") -> DataFrame:
    """uuid, label, start, stop, frames: a session's frames of one label with no gap longer than `gap` between them.

    On a stream, rows later than `delay` are dropped by the watermark; on a table it has no effect."""
    t = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    w = F.session_window(time, gap)
    return t.groupBy("uuid", label, w.alias("w")).agg(F.count("*").alias("frames")).select("uuid", label, F.col("w.start").alias("start"), F.col("w.end").alias("stop"), "frames")


def usage_by_window(events: DataFrame, time: str = "ts", label: str = "syllable", size: str = "1 hour", slide: str | None = None, delay: str = "2 hours") -> DataFrame:
    """start, stop, label, frames in tumbling or sliding windows."""
    t = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    w = F.window(time, size, slide) if slide else F.window(time, size)
    return t.groupBy(w.alias("w"), label).agg(F.count("*").alias("frames")).select(F.col("w.start").alias("start"), F.col("w.end").alias("stop"), label, "frames")
