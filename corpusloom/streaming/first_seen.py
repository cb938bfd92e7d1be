"""Streaming counterpart of the exact-duplicate filter and of the counts per year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_seen(stream: DataFrame, text: str, event_time: str, delay: str = "1 day") -> DataFrame:
    """Rows whose text wasn't seen within the watermark's delay; state is one hash pair per text, dropped after it."""
    hashed = stream.withColumn("_h1", F.xxhash64(F.lit(1), text)).withColumn("_h2", F.xxhash64(F.lit(2), text))
    return hashed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["_h1", "_h2"]).drop("_h1", "_h2")


def windowed_counts(stream: DataFrame, event_time: str, window: str = "1 day", delay: str = "1 hour", by: str | None = None) -> DataFrame:
    """Rows per tumbling window of event time, late rows up to the delay included."""
    keys = [F.window(event_time, window).alias("window"), *([F.col(by)] if by else [])]
    return stream.withWatermark(event_time, delay).groupBy(*keys).agg(F.count("*").alias("n"))
