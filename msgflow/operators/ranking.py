"""Numbering and neighbours inside a stream without putting a whole stream into one task.

One stream may hold most of a log, so no window here is partitioned by stream alone. Sequence
numbers are whole numbers, so a bucket of ``width`` of them has a proven size; only per-bucket
totals are combined across a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH_BITS = 18

# Spark itself cuts row_number() <= k before the shuffle up to this k.
MAP_SIDE_LIMIT = 1000


def _bucketed(df: DataFrame, seq: str, bits: int) -> DataFrame:
    return df.withColumn("_bucket", F.shiftright(F.col(seq), bits))


def rank_in_stream(
    df: DataFrame,
    keys: list[str],
    seq: str = "streamSeq",
    ties: list[str] | None = None,
    out: str = "rank",
    bits: int = WIDTH_BITS,
) -> DataFrame:
    """1, 2, 3 … per key in sequence order.

    ``ties`` names columns that order rows of one sequence number (several streams under one key).
    """
    bucketed = _bucketed(df, seq, bits)
    totals = bucketed.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(*keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(seq, *(ties or []))
    return (
        bucketed.join(bases, [*keys, "_bucket"])
        .withColumn(out, F.col("_base") + F.row_number().over(inside))
        .drop("_bucket", "_base")
    )


def first_in_stream(
    df: DataFrame, keys: list[str], k: int, seq: str = "streamSeq", ties: list[str] | None = None
) -> DataFrame:
    """The first k rows per key in sequence order."""
    if k <= MAP_SIDE_LIMIT:
        order = Window.partitionBy(*keys).orderBy(seq, *(ties or []))
        return df.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k).drop("_rank")
    return rank_in_stream(df, keys, seq, ties, "_rank").where(F.col("_rank") <= k).drop("_rank")


def previous_in_stream(
    df: DataFrame, keys: list[str], value: Column, out: str, seq: str = "streamSeq", bits: int = WIDTH_BITS
) -> DataFrame:
    """The value of the preceding row of the same key; null on the first one."""
    bucketed = _bucketed(df.withColumn("_value", value), seq, bits)
    edges = bucketed.groupBy(*keys, "_bucket").agg(F.max_by("_value", seq).alias("_edge"))
    carried = edges.select(
        *keys, "_bucket", F.lag("_edge").over(Window.partitionBy(*keys).orderBy("_bucket")).alias("_carry")
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(seq)
    return (
        bucketed.join(carried, [*keys, "_bucket"])
        .withColumn("_first", F.row_number().over(inside) == 1)
        .withColumn(out, F.when(F.col("_first"), F.col("_carry")).otherwise(F.lag("_value").over(inside)))
        .drop("_bucket", "_value", "_carry", "_first")
    )
