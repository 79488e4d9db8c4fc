"""Watermarked streaming operators over message and delivery streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def windowed_counts(messages: DataFrame, window: str, delay: str = "1 minute", by: Column | None = None) -> DataFrame:
    """Messages per tumbling window of broker time; a window comes out once the watermark passed it."""
    keys = [F.window("timestamp", window)] + ([by.alias("key")] if by is not None else [])
    return messages.withWatermark("timestamp", delay).groupBy(*keys).agg(F.count(F.lit(1)).alias("messages"))


def dedupe(deliveries: DataFrame, time: str, window: str) -> DataFrame:
    """The first delivery of each message; repeats within ``window`` of it are dropped."""
    return deliveries.withWatermark(time, window).dropDuplicatesWithinWatermark(["stream", "streamSeq"])
