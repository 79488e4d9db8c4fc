"""Sharding by a two-pass external shuffle.

First pass: a seeded hash of the whole record scatters records evenly over buckets of a bounded size. Second
pass: each bucket is put into a random order by Fisher-Yates with its own seed. Buckets one after the other are
the shuffled corpus; shards are equal cuts of it, so their row counts are at most one apart.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgflow.llm.tables import materialize
from msgflow.session import scratch, ship_package

SHARDS = 24
BUCKET_BYTES = 16 << 20
SEED = 20_001
LAW = "rows"


def record_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 8."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def shard(
    documents: DataFrame, shards: int = SHARDS, bucket_bytes: int = BUCKET_BYTES, seed: int = SEED
) -> DataFrame:
    """The documents with `shard` (0 to shards - 1) and `slot` (its place in the shard, gapless from 0).

    Columns of these names are replaced. Null or empty texts are records of 8 bytes. Equal rows get places of
    their own; if there are too many for a bucket, they are numbered and scattered by their numbers. The order depends on the
    rows and the seed only: a bucket is sorted by the rows' hashes before it is shuffled, so a task that runs again gives the
    same places. A bucket is as large as `bucket_bytes` on average, or as its largest record, so tasks stay bounded at
    any corpus size. No rows give no rows.
    """
    ship_package()
    rows = documents.drop("shard", "slot")
    hashed = [c.name for c in rows.schema if "map<" not in c.dataType.simpleString()]
    key = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in hashed])
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum(record_bytes(F.col("text"))), F.lit(0))).first()
    buckets = max(1, -(-total // bucket_bytes))
    scattered = _without_crowds(rows.withColumn("__key", key), bucket_bytes, seed)
    scattered = scattered.withColumn("__bucket", F.pmod(F.col("__key"), F.lit(buckets)))
    firsts = _first_places(scattered.groupBy("__bucket").agg(F.count("*").alias("n")))

    schema = T.StructType([*rows.schema, T.StructField("__place", T.LongType())])
    names = rows.columns

    def fisher_yates(bucket: pa.Table) -> pa.Table:
        """One bucket in its shuffled order, with each record's place in the corpus."""
        by_hash = np.argsort(bucket["__key"].to_numpy(), kind="stable")
        # Generator.shuffle is Fisher-Yates; the generator is seeded by the bucket.
        np.random.Generator(np.random.PCG64([seed, bucket["__bucket"][0].as_py()])).shuffle(by_hash)
        place = bucket["__first"][0].as_py() + np.arange(len(by_hash), dtype=np.int64)
        return bucket.select(names).take(by_hash).append_column("__place", pa.array(place))

    placed = scattered.join(firsts, "__bucket").groupBy("__bucket").applyInArrow(fisher_yates, schema)
    number = F.expr(f"__place * {shards} div {max(n, 1)}")
    first = F.expr(f"(__place * {shards} div {max(n, 1)} * {n} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", number.cast("int")).withColumn("slot", F.col("__place") - first).drop("__place")


def _without_crowds(hashed: DataFrame, most: int, seed: int) -> DataFrame:
    """Rows with a new __key where equal rows hold more than `most` bytes: their hash with a number. The numbers are written
    to a table first, so a task that runs again finds the same."""
    sizes = hashed.groupBy("__key").agg(F.sum(record_bytes(F.col("text"))).alias("bytes"))
    crowds = materialize(sizes.where(F.col("bytes") > most).select("__key"), "shard-crowds")  # at most total / most rows
    if crowds.isEmpty():
        return hashed
    many = hashed.join(crowds, "__key", "left_semi").withColumn("__number", F.monotonically_increasing_id())
    many = materialize(many, "shard-crowd-rows")
    many = many.withColumn("__key", F.xxhash64(F.lit(seed), "__key", "__number")).drop("__number")
    return hashed.join(crowds, "__key", "left_anti").unionByName(many)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; a bucket lies in few shards, so files are about as many as buckets."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_report(documents: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard (null under the law of rows), as read from the
    shards after they are written."""
    path = scratch(documents.sparkSession, "shards")
    sharded = shard(documents, **options)
    write_shards(sharded, path)
    return documents.sparkSession.read.schema(sharded.schema).parquet(path).select(
        "doc_id",
        record_bytes(F.col("text")).alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _first_places(counts: DataFrame) -> DataFrame:
    """(__bucket, __first) from rows per bucket: a running sum in blocks of 4096 buckets, then over the blocks."""
    table = materialize(counts.withColumn("block", F.expr("__bucket div 4096")), "shard-buckets")
    blocks = table.groupBy("block").agg(F.sum("n").alias("block_n"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("block", F.coalesce(F.sum("block_n").over(before), F.lit(0)).alias("block_first"))
    inside = Window.partitionBy("block").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    return table.join(blocks, "block").select(
        "__bucket", (F.col("block_first") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("__first")
    )
