"""Relays: read a log as a stream, rewrite subjects, publish to a log, acknowledge what is published."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from msgflow.functions.envelope import rewrite_subject
from msgflow.operators.codec import decode_payload
from msgflow.operators.delivery import Delivery
from msgflow.operators.envelope import conform_to_sink
from msgflow.operators.routing import filter_subjects
from msgflow.options import SinkOptions
from msgflow.sources.index import LogIndex
from msgflow.sources.log import MessageLog
from msgflow.sources.reading import RangeBatch, each_batch
from msgflow.sources.sink import batch_name, publish


def relay_rows(messages: DataFrame, pattern: str, replacement: str) -> DataFrame:
    """Messages with their subject rewritten, as sink rows. Works on tables and on streams."""
    renamed = messages.withColumn("subject", rewrite_subject(F.col("subject"), pattern, replacement))
    return conform_to_sink(renamed.withColumnRenamed("content", "data"))


def relay_table(messages: DataFrame, subjects: str, pattern: str, replacement: str) -> DataFrame:
    """The relay over a table of messages."""
    return relay_rows(filter_subjects(messages, subjects), pattern, replacement)


def relay_stream(
    spark: SparkSession, source: Mapping[str, object], sink: Mapping[str, object], pattern: str, replacement: str
) -> DataStreamWriter:
    """The relay as a streaming query; set checkpoint and trigger on the result and start it.

    Per micro-batch the rows are appended first and acknowledged after that, both under the batch id,
    so a replayed batch neither repeats messages nor loses acks. The messages are read where they are used, payloads for
    the append and numbers for the acks; nothing is kept between the two. Messages of one data file keep their order,
    files of a batch come in any. The consumer's position moves to the end of the batch, also past messages that its
    subjects leave out.
    """
    target = SinkOptions.from_options(sink)
    index = LogIndex(target.path.rstrip("/"))

    def handle(batch: RangeBatch, batch_id: int) -> None:
        read, session = batch.options, batch.log.spark
        stored = batch.stored()
        name = batch_name(stored, batch_id, target.writer)
        rows = relay_rows(decode_payload(stored, read.codec, strict=read.strict), pattern, replacement)
        publish(MessageLog(session, target.path, index), rows, target.stream, name, target.subjects)
        if read.consumer and not read.ack_none:
            consumer = Delivery(batch.log, read.consumer)
            consumer.write_acks(stored, name, F.current_timestamp(), closed=True)
            consumer.store.advance(batch.ends)

    return each_batch(spark, source, handle)
