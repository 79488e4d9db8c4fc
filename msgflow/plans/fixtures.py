"""Message logs and delivery state derived from the driver tables.

Every event becomes one message of one of four partition streams; deliveries and acks follow from
the sequence number, so that the same state can be written down in SQL.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgflow.functions import envelope as E
from msgflow.functions.subjects import partition_stream
from msgflow.operators.codec import recode_batch
from msgflow.session import scratch, ship_package
from msgflow.sources.log import MessageLog
from msgflow.sources.sink import publish

PREFIX = "EV"
PARTITIONS = 4
STREAMS = [f"{PREFIX}-{n}" for n in range(PARTITIONS)]
DOMAIN, ACCOUNT, CONSUMER = "dom", "acct", "cons"
ACK_WAIT = 90
HEARTBEAT = "heartbeat"
LATE_ACK = "2024-01-21 12:00:00"
LATE_ATTEMPT, LATE_DAYS = 9, 40

_logs: dict[tuple[str, str], MessageLog] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as sink rows: subject, data, headers, with stream, timestamp and event_id next to them."""
    event_id, user_id = F.col("event_id"), F.col("user_id").cast("string")
    headers = F.create_map(
        F.lit("type"), F.array("event_type", user_id), F.lit("id"), F.array(event_id.cast("string"))
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat_ws(".", F.lit("events"), "event_type", user_id).alias("subject"),
        E.utf8_bytes(F.col("props")).alias("data"),
        F.when(event_id % 5 != 0, headers).alias("headers"),
        partition_stream(PREFIX, F.col("user_id") % PARTITIONS).alias("stream"),
        F.timestamp_micros(E.micros_of_ntz(F.col("ts"))).alias("timestamp"),
        "event_type",
    )


def new_log(spark: SparkSession, name: str) -> MessageLog:
    return MessageLog(spark, scratch(spark, name))


def publish_events(log: MessageLog, messages: DataFrame, batch: str) -> int:
    return publish(
        log, messages, F.col("stream"), batch, order_by=["event_id"], timestamp=F.col("timestamp")
    )


def event_log(spark: SparkSession, sf_dir: str) -> MessageLog:
    """The log of all events, published once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _logs:
        log = new_log(spark, "events")
        publish_events(log, event_messages(spark, sf_dir), "events")
        _logs[key] = log
    return MessageLog(spark, _logs[key].path)


def deliveries(messages: DataFrame) -> DataFrame:
    """One to three delivery attempts per message, an ack wait apart."""
    attempt = F.explode(F.sequence(F.lit(1).cast("long"), 1 + F.col("streamSeq") % 3))
    return messages.select("stream", "streamSeq", "timestamp", attempt.alias("attempt")).select(
        F.lit(CONSUMER).alias("consumer"),
        "stream",
        "streamSeq",
        _later(F.col("timestamp"), (F.col("attempt") - 1) * ACK_WAIT).alias("delivered_at"),
        "attempt",
    )


def late_deliveries(messages: DataFrame) -> DataFrame:
    """One more delivery of every nineteenth message, days after all acks."""
    return messages.where(F.col("streamSeq") % 19 == 0).select(
        F.lit(CONSUMER).alias("consumer"),
        "stream",
        "streamSeq",
        _later(F.col("timestamp"), F.lit(LATE_DAYS * 86_400).cast("long")).alias("delivered_at"),
        F.lit(LATE_ATTEMPT).cast("long").alias("attempt"),
    )


def acks(messages: DataFrame) -> DataFrame:
    """All messages but every eleventh are acknowledged: up to two minutes after the last delivery, every
    thirteenth right after the first one, and every seventeenth at a late time of its own."""
    seq = F.col("streamSeq")
    soon = F.when(seq % 13 == 0, 1).otherwise(seq % 3 * ACK_WAIT + seq % 7 * 20)
    late = F.timestamp_micros(E.micros_of_ntz(F.expr(f"timestamp_ntz'{LATE_ACK}'")))
    return messages.where(seq % 11 != 0).select(
        F.lit(CONSUMER).alias("consumer"),
        "stream",
        "streamSeq",
        F.when(seq % 17 == 0, late).otherwise(_later(F.col("timestamp"), soon)).alias("acked_at"),
    )


def heartbeat(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """One acknowledged delivery long after all others, so that watermarks pass the last real one."""
    at = F.timestamp_micros(E.micros_of_ntz(F.expr("timestamp_ntz'2100-01-01 00:00:00'")))
    values = {
        "consumer": F.lit(CONSUMER),
        "stream": F.lit(HEARTBEAT),
        "streamSeq": F.lit(0),
        "attempt": F.lit(1),
        "delivered_at": at,
        "acked_at": at,
    }
    return spark.range(1).select(*[values[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def _later(ts: Column, seconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + seconds * 1_000_000)


def deflate(df: DataFrame, column: str) -> DataFrame:
    """zlib-compress a binary column on executors."""

    def pack(payload: bytes | None) -> tuple[bytes | None, bool]:
        return None if payload is None else zlib.compress(payload), True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from recode_batch(batch, column, pack)

    ship_package()
    return df.mapInArrow(run, df.schema)
