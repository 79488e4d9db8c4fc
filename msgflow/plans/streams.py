"""Registered streaming queries: each runs a stream over all its input to the end and returns what it wrote."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from msgflow import schemas
from msgflow.functions import envelope as E
from msgflow.functions.subjects import subject_token
from msgflow.operators.delivery import Delivery
from msgflow.operators.routing import route_by_token
from msgflow.plans import fixtures as X
from msgflow.session import scratch, state_partitions
from msgflow.sources.consumers import ConsumerStore
from msgflow.sources.index import LogIndex
from msgflow.sources.log import MessageLog
from msgflow.sources.reading import RangeBatch, each_batch, read_stream, register
from msgflow.sources.sink import publish, write_stream
from msgflow.streaming.relay import relay_rows, relay_stream
from msgflow.streaming.redelivery import redeliver, redeliveries
from msgflow.streaming.stateful import dedupe, windowed_counts


def _run(spark: SparkSession, writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Run a stream over everything available now, to the end."""
    with state_partitions(spark):
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _run_until_idle(spark: SparkSession, writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Run with the default trigger until nothing is left to do, also the closing of windows.

    An available-now run over a Python source is a single batch, so it ends before its watermark acts.
    """
    with state_partitions(spark):
        query = writer.option("checkpointLocation", checkpoint).start()
    query.processAllAvailable()
    query.stop()
    return query


def _to_files(
    spark: SparkSession, stream: DataFrame, folder: str | None = None, checkpoint: str | None = None, run=_run
) -> DataFrame:
    folder = folder or scratch(spark, "stream-out")
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", folder)
    run(spark, writer, checkpoint or scratch(spark, "stream-ck"))
    return spark.read.schema(stream.schema).parquet(folder)


def _source(log: MessageLog, **more: object) -> dict[str, object]:
    return {"path": log.path, "stream_prefix": X.PREFIX, "num_partitions": X.PARTITIONS, **more}


def _rows(df: DataFrame) -> DataFrame:
    return df.select(
        "subject", "stream", "streamSeq", F.col("content").cast("string").alias("content"), "pending",
        F.unix_micros("timestamp").alias("timestamp_us"),
    )


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    messages = X.event_messages(spark, sf_dir)
    early = F.col("event_type").isin("purchase", "view")
    return messages.where(early), messages.where(~early)


# -- source ------------------------------------------------------------------------


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = X.event_log(spark, sf_dir)
    return _rows(_to_files(spark, read_stream(spark, **_source(log))))


def stream_listeners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three listeners share the log: every message has one taker, and all of them get some."""
    log = X.event_log(spark, sf_dir)
    seen = _to_files(spark, read_stream(spark, **_source(log, listeners=3, columns="stream,streamSeq,listener")))
    taken = seen.groupBy("stream", "streamSeq").agg(F.countDistinct("listener").alias("takers"))
    return taken.crossJoin(F.broadcast(seen.agg(F.countDistinct("listener").alias("listeners"))))


def stream_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subject filter inside the source."""
    log = X.event_log(spark, sf_dir)
    wanted = {"subjects": "events.purchase.>, events.*.7", "columns": "subject,stream,streamSeq"}
    return _to_files(spark, read_stream(spark, **_source(log, **wanted)))


def stream_text5(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = X.event_log(spark, sf_dir)
    options = _source(log, envelope="text5", consumer=f"c-{uuid.uuid4().hex[:8]}")
    return _to_files(spark, read_stream(spark, received_at=F.col("timestamp"), **options))


def stream_text3(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = X.event_log(spark, sf_dir)
    return _to_files(spark, read_stream(spark, **_source(log, envelope="text3")))


def stream_inflate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents published compressed and decoded by the source."""
    log = X.new_log(spark, "packed")
    docs = X.table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc."), F.col("doc_id").cast("string")).alias("subject"),
        E.utf8_bytes(F.col("text")).alias("data"),
    )
    publish(log, X.deflate(docs, "data"), "DOCS", "docs")
    messages = read_stream(spark, path=log.path, stream="DOCS", codec="zlib", columns="subject,content")
    text = messages.select("subject", F.col("content").cast("string").alias("text"))
    return _to_files(spark, text)


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs on one checkpoint with an append between them: no gap, no repeat."""
    log = X.new_log(spark, "resume")
    first, second = _halves(spark, sf_dir)
    folder, checkpoint = scratch(spark, "resume-out"), scratch(spark, "resume-ck")
    source = read_stream(spark, **_source(log, columns="stream,streamSeq,subject"))
    X.publish_events(log, first, "one")
    _to_files(spark, source, folder, checkpoint)
    X.publish_events(log, second, "two")
    return _to_files(spark, source, folder, checkpoint)


def stream_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of a seventh of the log at most: one run of a single batch, then a restart that goes on to the end."""
    log, folder, checkpoint = X.event_log(spark, sf_dir), scratch(spark, "bounded-out"), scratch(spark, "bounded-ck")
    most = sum(log.heads().values()) // 7 + 1

    def keep(batch: RangeBatch, batch_id: int) -> None:
        rows = batch.stored().select("stream", "streamSeq", F.lit(batch_id).alias("part"))
        rows.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    for run in (_run, _run_until_idle):
        run(spark, each_batch(spark, _source(log, max_batch_rows=most), keep), checkpoint)
    seen = spark.read.schema("stream string, streamSeq bigint, part bigint").parquet(f"{folder}/*")
    sizes = seen.groupBy("part").agg(F.count("*").alias("n")).agg(
        (F.max("n") <= most).alias("within"), F.count("*").alias("batches")
    )
    taken = seen.groupBy("stream", "streamSeq").agg(F.count("*").alias("seen"))
    return taken.crossJoin(F.broadcast(sizes))  # one row


def stream_durable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A named consumer keeps its position by its acks, without the first run's checkpoint."""
    log = X.new_log(spark, "durable")
    target = scratch(spark, "durable-target")
    name = f"c-{uuid.uuid4().hex[:8]}"
    source = _source(log, consumer=name)
    first, second = _halves(spark, sf_dir)
    for part, batch in ((first, "one"), (second, "two")):
        X.publish_events(log, part, batch)
        sink = {"path": target, "stream": "OUT"}
        _run(spark, relay_stream(spark, source, sink, r"(.+)", "done.$1"), scratch(spark, "durable-ck"))
    relayed = MessageLog(spark, target).scan()
    return relayed.select("subject", F.col("content").cast("string").alias("content"))


def stream_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With reset_on_restart the first batch after a restart starts at the beginning again."""
    log = X.new_log(spark, "reset")
    first, second = _halves(spark, sf_dir)
    folder, checkpoint = scratch(spark, "reset-out"), scratch(spark, "reset-ck")
    source = read_stream(spark, **_source(log, reset_on_restart="true", columns="stream,streamSeq"))
    X.publish_events(log, first, "one")
    _to_files(spark, source, folder, checkpoint)
    X.publish_events(log, second, "two")
    seen = _to_files(spark, source, folder, checkpoint)
    return seen.groupBy("stream", "streamSeq").agg(F.count(F.lit(1)).alias("seen"))


def _position(log: MessageLog, name: str, wanted: dict[str, int], seconds: float = 30) -> DataFrame:
    """The consumer's position; progress reports come a moment after the run's end."""
    store, until = ConsumerStore(log.path, name), time.monotonic() + seconds
    while store.floors() != wanted and time.monotonic() < until:
        time.sleep(0.05)
    return log.spark.createDataFrame(sorted(store.floors().items()), "stream string, ack_floor bigint")


def stream_consumer_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A named consumer with default options on a plain sink: one run gives everything and acknowledges it."""
    log, name = X.event_log(spark, sf_dir), f"c-{uuid.uuid4().hex[:8]}"
    seen = _to_files(spark, read_stream(spark, **_source(log, consumer=name, columns="stream,streamSeq")))
    return seen.join(F.broadcast(_position(log, name, log.heads())), "stream")


def stream_consumer_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A relay whose first match comes after half of the stream; the consumer ends behind the last message."""
    log, target, name = X.new_log(spark, "filtered"), scratch(spark, "filtered-target"), f"c-{uuid.uuid4().hex[:8]}"
    events = X.table(spark, sf_dir, "events")
    half = F.when(F.col("event_id") * 2 >= F.lit(events.count()), "late.hit").otherwise("early.miss")
    rows = events.select("event_id", half.alias("subject"), E.utf8_bytes(F.col("props")).alias("data"))
    publish(log, rows, "ALL", "events", order_by=["event_id"])
    source = {"path": log.path, "stream": "ALL", "consumer": name, "subjects": "late.hit"}
    writer = relay_stream(spark, source, {"path": target, "stream": "HITS"}, r"(.+)", "done.$1")
    _run(spark, writer, scratch(spark, "filtered-ck"))
    floor = _position(log, name, log.heads()).select("ack_floor")
    hits = MessageLog(spark, target).scan().select((F.col("streamSeq") + F.lit(events.count() - _count(target))).alias("streamSeq"))
    return hits.crossJoin(F.broadcast(floor))


def _count(path: str) -> int:
    return sum(LogIndex(path).heads().values())


def stream_empty_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run without new messages gives nothing and fails at nothing."""
    log = X.event_log(spark, sf_dir)
    folder, checkpoint = scratch(spark, "empty-out"), scratch(spark, "empty-ck")
    source = read_stream(spark, **_source(log, columns="stream,streamSeq"))
    for _ in range(2):
        seen = _to_files(spark, source, folder, checkpoint)
    return seen.withColumn("runs", F.lit(2).cast("long"))


def stream_bind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader that only attaches to a consumer takes the subjects that the consumer was made with."""
    log, name = X.event_log(spark, sf_dir), f"c-{uuid.uuid4().hex[:8]}"
    ConsumerStore(log.path, name).open(create=True, subjects=("events.click.>",))
    bound = _source(log, consumer=name, create_consumer="false", columns="stream,streamSeq")
    return _to_files(spark, read_stream(spark, **bound))


def stream_processing_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A running query with a processing-time trigger, stopped when all is done."""

    def run(spark: SparkSession, writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
        return _run_until_idle(spark, writer.trigger(processingTime="1 second"), checkpoint)

    log = X.event_log(spark, sf_dir)
    return _to_files(spark, read_stream(spark, **_source(log, columns="stream,streamSeq")), run=run)


def format_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The format as a table: full envelopes of everything committed."""
    log = X.event_log(spark, sf_dir)
    register(spark)
    messages = spark.read.format("msglog").options(**{k: str(v) for k, v in _source(log).items()}).load()
    return messages.select("stream", "streamSeq", "subject", F.col("content").cast("string").alias("content"), "pending")


def publish_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages routed by a subject token; those without one are split off and counted, the rest is published."""
    number = F.when(F.col("user_id") % 4 != 1, (F.col("user_id") % 4).cast("string")).otherwise("none")
    messages = X.table(spark, sf_dir, "events").select(
        "event_id", F.concat_ws(".", F.lit("app"), number).alias("subject"), E.utf8_bytes(F.col("props")).alias("data")
    )
    routed = route_by_token(messages, "PART", 2)
    lost = routed.where("stream is null").count()
    log = X.new_log(spark, "routed")
    publish(log, routed.where("stream is not null"), F.col("stream"), "events", order_by=["event_id"])
    return log.scan().select(
        "stream", "streamSeq", F.col("content").cast("string").alias("content"), F.lit(lost).cast("long").alias("unroutable")
    )


# -- sink and relay ----------------------------------------------------------------


def stream_relay(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = X.event_log(spark, sf_dir)
    target = scratch(spark, "relay-target")
    sink = {"path": target, "stream": "DONE", "subjects": "done.>"}
    _run(spark, relay_stream(spark, _source(log), sink, r"(.+)", "done.$1"), scratch(spark, "relay-ck"))
    relayed = MessageLog(spark, target).scan()
    return relayed.select(
        "stream",
        "subject",
        F.col("content").cast("string").alias("content"),
        F.array_join(F.try_element_at("headers", F.lit("type")), ",").alias("header_type"),
    )


def stream_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed sink: numbers 1 … n, each once, over all relayed messages."""
    log = X.event_log(spark, sf_dir)
    target = scratch(spark, "sink-target")
    rows = relay_rows(read_stream(spark, **_source(log, subjects="events.click.>")), r"(.+)", "copy.$1")
    _run(spark, write_stream(rows, path=target, stream="COPY"), scratch(spark, "sink-ck"))
    return MessageLog(spark, target).scan().select("stream", "streamSeq")


def stream_acks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a relay with a named consumer has acknowledged after its batch."""
    log = X.event_log(spark, sf_dir)
    name = f"c-{uuid.uuid4().hex[:8]}"
    sink = {"path": scratch(spark, "acks-target"), "stream": "DONE"}
    source = _source(log, consumer=name)
    _run(spark, relay_stream(spark, source, sink, r"(.+)", "done.$1"), scratch(spark, "acks-ck"))
    consumer = Delivery(log, name)
    floors = consumer.advance_floors()
    rows = [(s, int(f)) for s, f in sorted(floors.items())]
    held = spark.createDataFrame(rows, "stream string, ack_floor bigint")
    return consumer.acks().groupBy("stream").agg(F.count(F.lit(1)).alias("acked")).join(held, "stream")


# -- state -------------------------------------------------------------------------


def stream_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = X.event_log(spark, sf_dir)
    messages = read_stream(spark, **_source(log, columns="subject,timestamp"))
    counts = windowed_counts(messages, "6 hours", "1 minute", subject_token(F.col("subject"), 2))
    flat = counts.select(
        F.unix_micros("window.start").alias("start_us"), "key", "messages"
    )
    return _to_files(spark, flat, run=_run_until_idle)


def _delivery_streams(spark: SparkSession, sf_dir: str, only_first: bool = False) -> tuple[DataFrame, DataFrame]:
    """Deliveries and acks as file streams; every nineteenth message is delivered once more, days after its ack."""
    messages = X.event_log(spark, sf_dir).scan()
    deliveries = X.deliveries(messages)
    if only_first:
        deliveries = deliveries.where("attempt = 1")
    else:
        deliveries = deliveries.unionByName(X.late_deliveries(messages))
    found = []
    for name, df, schema in (("deliveries", deliveries, schemas.DELIVERIES), ("acks", X.acks(messages), schemas.ACKS)):
        folder = scratch(spark, name)
        df.unionByName(X.heartbeat(spark, df.schema)).write.parquet(folder)
        found.append(spark.readStream.schema(schema).parquet(folder).drop("batch"))
    return found[0], found[1]


def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    deliveries, _ = _delivery_streams(spark, sf_dir)
    real = (F.col("stream") != X.HEARTBEAT) & (F.col("attempt") < X.LATE_ATTEMPT)
    once = dedupe(deliveries.where(real), "delivered_at", "10 minutes")
    return _to_files(spark, once.select("stream", "streamSeq"))


def stream_redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries whose wait ended without an ack, among them repeats of messages acknowledged days before."""
    deliveries, acks = _delivery_streams(spark, sf_dir)
    due = redeliveries(deliveries, acks, X.ACK_WAIT)
    return _to_files(spark, due.select("stream", "streamSeq", "attempt", F.unix_micros("delivered_at").alias("delivered_us")))


def stream_resend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is sent again after each ack wait until an ack came, at most five times in all."""
    deliveries, acks = _delivery_streams(spark, sf_dir, only_first=True)
    again = redeliver(deliveries, acks, X.ACK_WAIT, max_deliver=5)
    return _to_files(spark, again.select("stream", "streamSeq", "attempt", F.unix_micros("delivered_at").alias("delivered_us")))


QUERIES = {
    f.__name__: f
    for f in (
        stream_replay,
        stream_listeners,
        stream_consumer_default,
        stream_consumer_filtered,
        stream_empty_batch,
        stream_bounded,
        stream_bind,
        stream_processing_time,
        format_table_scan,
        publish_routed,
        stream_filtered,
        stream_text5,
        stream_text3,
        stream_inflate,
        stream_resume,
        stream_durable,
        stream_reset,
        stream_relay,
        stream_sink,
        stream_acks,
        stream_watermark,
        stream_dedupe,
        stream_redelivery,
        stream_resend,
    )
}
