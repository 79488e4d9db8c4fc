"""Shared pieces: working tables in the shared folder, row numbers in key order, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgflow.session import scratch

# monotonically_increasing_id() holds the row's place within its partition in the low 33 bits.
_PLACE = (1 << 33) - 1


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table below spark.checkpoint.dir and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: list[Column], name: str, index: str = "idx") -> DataFrame:
    """Rows with gapless numbers from 0 in the given order, without sorting in one task.

    Rows are dealt out by ranges of the order; a table with one row per range gives each its first number.
    Rows that tie in the order may swap numbers, so order by everything that tells rows apart.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    table = materialize(
        ranged.withColumn("__part", F.spark_partition_id()).withColumn(
            "__place", F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE))
        ),
        name,
    )
    parts = table.groupBy("__part").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = parts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    # One row per partition of the sort, so the side is bounded by the number of tasks.
    return (
        table.join(F.broadcast(firsts), "__part")
        .withColumn(index, F.col("__first") + F.col("__place"))
        .drop("__part", "__place", "__n", "__first")
    )


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) for every node of the undirected edges (a, b); component is the smallest node reached.

    Alternates large-star and small-star steps until the edges are stars. Each step joins edges with one row
    per node, so a node with very many edges can be split over tasks.
    """
    current = materialize(_downward(edges.select("a", "b")), name)
    while not _are_stars(current):
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(lowest, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = materialize(_downward(moved.union(lowest.select("a", F.col("m").alias("b")))), name)
    members = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.union(members.select(F.col("component").alias("node"), "component").distinct())


def _downward(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger node to the smaller."""
    return edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour, which has none, or only larger ones."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 or (up = 1 and down = 1)").isEmpty()
