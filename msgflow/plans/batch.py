"""Registered table queries. Results are scalar columns over all rows of the input tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msgflow.functions import envelope as E
from msgflow.functions.subjects import partition_number, partition_subject, subject_token
from msgflow.operators import delivery as D
from msgflow.operators import envelope as M
from msgflow.operators import planning as P
from msgflow.operators import routing as R
from msgflow.operators.codec import decode_payload
from msgflow.plans import fixtures as X
from msgflow.sources.log import MessageLog
from msgflow.sources.sink import publish_messages, publish_text
from msgflow.streaming.relay import relay_table

# Fixed times used where an operator needs a present moment.
NOW = "2024-01-20 12:00:00"
FULL_PATTERN, FULL_REPLACEMENT = r"(.+)", "done.$1"


def _now() -> Column:
    return F.timestamp_micros(E.micros_of_ntz(F.expr(f"timestamp_ntz'{NOW}'")))


def _text(name: str, out: str | None = None) -> Column:
    return F.col(name).cast("string").alias(out or name)


def _us(name: str) -> Column:
    return F.unix_micros(name).alias(f"{name}_us")


def _header(name: str, out: str) -> Column:
    return F.array_join(F.try_element_at("headers", F.lit(name)), ",").alias(out)


def _log(spark: SparkSession, sf_dir: str) -> MessageLog:
    return X.event_log(spark, sf_dir)


def _envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    return M.deliver(log.scan(), log.heads(), X.CONSUMER, X.DOMAIN, X.ACCOUNT, 1 + F.col("streamSeq") % 3)


# -- relay and envelopes ---------------------------------------------------------


def relay_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    relayed = relay_table(_envelopes(spark, sf_dir), "events.purchase.>", FULL_PATTERN, FULL_REPLACEMENT)
    return relayed.select("subject", _text("data"), _header("type", "header_type"))


def relay_partition_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subjects ``subject.<p>`` relayed to ``done.<p>``."""
    messages = _log(spark, sf_dir).scan()
    numbered = messages.withColumn("subject", partition_subject(partition_number(F.col("stream")), "subject"))
    renamed = E.rewrite_subject(F.col("subject"), r"subject.(.+)", FULL_REPLACEMENT)
    return numbered.select("stream", "streamSeq", "subject", renamed.alias("relayed"))


def envelope_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _envelopes(spark, sf_dir).select(
        "subject",
        "replyTo",
        _text("content"),
        _header("type", "header_type"),
        _header("id", "header_id"),
        "domain",
        "stream",
        "consumer",
        "delivered",
        "streamSeq",
        "consumerSeq",
        _us("timestamp"),
        "pending",
    )


def reply_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    wire = _envelopes(spark, sf_dir).select("subject", "replyTo", "content", "headers")
    return M.to_full_envelope(wire).select(
        "replyTo", "domain", "stream", "consumer", "delivered", "streamSeq", "consumerSeq", _us("timestamp"), "pending"
    )


def envelope_text5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.to_text5(_envelopes(spark, sf_dir), F.col("timestamp"))


def envelope_text3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.to_text3(_envelopes(spark, sf_dir))


def headers_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header pairs to a multi-valued map, null without headers."""
    pairs = F.array(
        F.struct(F.lit("type").alias("key"), F.col("event_type").alias("value")),
        F.struct(F.lit("id").alias("key"), F.col("event_id").cast("string").alias("value")),
        F.struct(F.lit("type").alias("key"), F.col("user_id").cast("string").alias("value")),
    )
    given = F.filter(pairs, lambda _: F.col("event_id") % 5 != 0)
    headers = X.table(spark, sf_dir, "events").select("event_id", E.headers_from_pairs(given).alias("headers"))
    return headers.select(
        "event_id",
        F.array_join(F.map_keys("headers"), ",").alias("names"),
        _header("type", "header_type"),
        _header("id", "header_id"),
        F.col("headers").isNull().alias("absent"),
    )


def headers_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log(spark, sf_dir).scan().select("stream", "streamSeq", E.headers_json(F.col("headers")).alias("headers"))


def meta_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    metadata = E.metadata_json(
        *[F.col(c) for c in ("stream", "streamSeq", "consumerSeq", "delivered", "pending", "timestamp")]
    )
    return _envelopes(spark, sf_dir).select("stream", "streamSeq", metadata.alias("metadata"))


def message_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.to_message_json(_envelopes(spark, sf_dir), F.col("timestamp")).select("stream", "streamSeq", "message")


def time_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    nanos = E.epoch_micros(F.col("timestamp")) * 1000 + 999
    return _log(spark, sf_dir).scan().select(
        "stream",
        "streamSeq",
        E.format_time(F.col("timestamp"), "MM/dd/yyyy - HH:mm:ss Z").alias("received"),
        E.iso_time(F.col("timestamp")).alias("iso"),
        F.unix_micros(E.event_time(nanos)).alias("event_us"),
    )


def text_codecs(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return X.table(spark, sf_dir, "documents").select(
        "doc_id",
        E.utf8_text(E.utf8_bytes(text)).alias("utf8"),
        E.ascii_text(E.utf8_bytes(text)).alias("ascii_read"),
        E.utf8_text(E.ascii_bytes(text)).alias("ascii_written"),
    )


def origin_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = E.with_origin(F.col("headers"), E.iso_time(F.col("timestamp")))
    return _log(spark, sf_dir).scan().select("stream", "streamSeq", headers.alias("headers")).select(
        "stream",
        "streamSeq",
        F.size("headers").cast("long").alias("n_headers"),
        _header("originTimestamp", "origin"),
        _header("type", "header_type"),
    )


def legacy_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.legacy_sink_rows(M.to_text5(_envelopes(spark, sf_dir), F.col("timestamp")))
    return M.conform_to_sink(rows).select(
        "subject", _text("data"), _header("originTimestamp", "origin"), _header("type", "header_type")
    )


def constant_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = _log(spark, sf_dir).scan()
    fixed = messages.withColumn("subject", F.lit("out.all")).withColumn("data", F.lit(bytearray(b"payload")))
    return M.conform_to_sink(fixed).select("subject", _text("data"), _header("id", "header_id"))


# -- subjects, streams, routing ----------------------------------------------------


def subject_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = R.filter_subjects(_log(spark, sf_dir).scan(), "events.click.1, events.view.2,events.error.3")
    return found.select("subject", "stream", "streamSeq")


def subject_wildcard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = R.filter_subjects(_log(spark, sf_dir).scan(), "events.*.7, events.purchase.>, other.>")
    return found.select("subject", "stream", "streamSeq")


def subject_patterns_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user's pattern, plus one per event type and one for all, against every message."""
    events = X.table(spark, sf_dir, "events")
    by_user = events.select(F.concat(F.lit("events.*."), F.col("user_id").cast("string")).alias("pattern"))
    by_type = events.select(F.concat(F.lit("events."), "event_type", F.lit(".>")).alias("pattern"))
    patterns = by_user.union(by_type).distinct().union(spark.createDataFrame([("events.>",)], "pattern string"))
    messages = _log(spark, sf_dir).scan().select("subject", "stream", "streamSeq")
    return R.match_patterns(messages, patterns)


def stream_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir).scan()
    by_name = P.select_streams(log, streams=["EV-1", "EV-3"]).withColumn("how", F.lit("name"))
    by_prefix = P.select_streams(log, prefix="EV").withColumn("how", F.lit("prefix"))
    return by_name.unionByName(by_prefix).select("how", "stream", "streamSeq")


def non_null_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = _log(spark, sf_dir).scan().select("stream", "streamSeq", F.col("headers")["id"][0].alias("msg_id"))
    return messages.where(F.col("msg_id").isNotNull())


def route_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition subjects ``app.<n>.log`` routed to the stream that their token names."""
    number = (F.col("user_id") % X.PARTITIONS).cast("int")
    messages = X.table(spark, sf_dir, "events").select(
        "event_id", partition_subject(number, "app", "log").alias("subject")
    )
    routed = R.route_by_token(messages, "PART", 2)
    return routed.select(
        "event_id",
        "subject",
        "stream",
        partition_number(F.col("stream")).alias("partition"),
        subject_token(F.col("subject"), -1).alias("tail"),
    )


def fanout_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = R.fan_out(_log(spark, sf_dir).scan(), F.lit("subject1, subject2,,subject3"))
    return copies.select("subject", "stream", "streamSeq", _text("content"))


def stream_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages a stream with these subjects would refuse."""
    refused = R.off_stream(_log(spark, sf_dir).scan(), "events.purchase.>,events.view.*")
    return refused.select("subject", "stream", "streamSeq")


# -- offsets and plans -------------------------------------------------------------


def latest_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.latest_offsets(_log(spark, sf_dir).scan())


def range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    start = {"EV-0": 30, "EV-1": 0, "EV-2": 100}
    end = {"EV-0": 60, "EV-1": 45, "EV-2": log.heads()["EV-2"]}
    return P.range_scan(log.scan(), start, end).select("stream", "streamSeq", "subject", _text("content"))


def clamped_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    end = P.clamp_end({"EV-0": 10**12, "EV-1": 77, "EV-3": 10**9, "EV-9": 5}, log.heads())
    return P.range_scan(log.scan(), {}, end).select("stream", "streamSeq", "subject")


def reset_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    stored = {"EV-0": 20, "EV-1": 21, "EV-2": 22, "EV-3": 23}
    cases = {
        "first": P.start_offsets(X.STREAMS, None),
        "resume": P.start_offsets(X.STREAMS, stored),
        "reset": P.start_offsets(X.STREAMS, stored, reset_on_restart=True),
        "after_reset": P.start_offsets(X.STREAMS, stored, reset_on_restart=True, first_batch=False),
    }
    found = None
    for name, start in cases.items():
        part = P.range_scan(log.scan(), start, log.heads()).select(F.lit(name).alias("start"), "stream", "streamSeq")
        found = part if found is None else found.unionByName(part)
    return found


def batch_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = {"EV-0": 17, "EV-1": 0, "EV-2": 5}
    log = _log(spark, sf_dir)
    rest = P.range_scan(log.scan(), start, log.heads())
    return (
        P.batch_slices(rest, start, 64)
        .groupBy("stream", "slice")
        .agg(F.count(F.lit(1)).alias("n"), F.min("streamSeq").alias("lo"), F.max("streamSeq").alias("hi"))
    )


def listener_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.listener_share(_log(spark, sf_dir).scan(), 3).select("listener", "stream", "streamSeq")


def next_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    floors = {"EV-0": 10, "EV-1": 0, "EV-2": 33}
    fetched = P.next_fetch(_log(spark, sf_dir).scan(), floors, 100, max_request_batch=40)
    return fetched.select("stream", "streamSeq", "subject")


# -- delivery ----------------------------------------------------------------------


def pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = _log(spark, sf_dir).scan().select("stream", "streamSeq", "subject", "timestamp")
    return D.pending_messages(messages, X.acks(messages)).select("stream", "streamSeq", "subject")


def pending_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    return D.pending_counts(log.heads_frame(), X.acks(log.scan()))


def ack_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    return D.ack_floors(log.heads_frame(), X.acks(log.scan())).select("stream", "ack_floor")


def consumer_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag of a consumer that has acknowledged everything before the last tenth of each stream."""
    log = _log(spark, sf_dir)
    heads = log.heads()
    done = P.range_scan(log.scan(), {}, {s: h - h // 10 for s, h in heads.items()})
    return D.ack_floors(log.heads_frame(), done).select("stream", "ack_floor", "head", "lag")


def delivery_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.delivery_counts(X.deliveries(_log(spark, sf_dir).scan()))


def repeated_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.repeated_messages(X.deliveries(_log(spark, sf_dir).scan()))


def distinct_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.drop_repeats(X.deliveries(_log(spark, sf_dir).scan()).select("stream", "streamSeq"))


def redelivery_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = _log(spark, sf_dir).scan()
    due = D.redelivery_due(X.deliveries(messages), X.acks(messages), X.ACK_WAIT, _now())
    return due.select("consumer", "stream", "streamSeq", _us("delivered_at"), "attempts")


def inflight_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = _log(spark, sf_dir).scan()
    held = D.inflight_capped(messages.select("stream", "streamSeq", "subject"), X.acks(messages), {}, 12)
    return held.select("stream", "streamSeq", "subject")


def idle_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = D.idle_gaps(_log(spark, sf_dir).scan().select("stream", "streamSeq", "timestamp"), 30)
    return gaps.select("stream", "streamSeq", "gap_us")


def _consumer(spark: SparkSession, sf_dir: str, ack_none: bool = False) -> D.Delivery:
    """A consumer of its own, so that runs do not see each other's acks."""
    return D.Delivery(_log(spark, sf_dir), f"c-{uuid.uuid4().hex[:8]}", ack_none)


def pull_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second of two pulls by two listeners while the first is still unacknowledged."""
    consumer = _consumer(spark, sf_dir)
    consumer.pull_batch("p1", _now(), fetch=60, listeners=2)
    second = consumer.pull_batch("p2", _now(), fetch=60, listeners=2)
    return second.select("listener", "stream", "streamSeq", "attempt", _text("content"))


def pull_fair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four pulls of a consumer that may hold ten messages of a stream: one stream is far behind the others, and when it
    is at its cap the pulls go to them."""
    consumer = _consumer(spark, sf_dir)
    consumer.store.open(create=True, ack_wait=3600, max_ack_pending=10)
    heads = F.broadcast(consumer.log.heads_frame())  # one row per stream
    done = consumer.log.scan().join(heads, "stream").where((F.col("stream") != X.STREAMS[0]) & (F.col("streamSeq") * 2 <= F.col("head")))
    consumer.write_acks(done, "seed", _now())
    consumer.advance_floors()
    pulls = [consumer.pull_batch(f"p{k}", _now(), fetch=10).select(F.lit(k).alias("pull"), "stream", "streamSeq") for k in range(1, 5)]
    return reduce(DataFrame.union, pulls)


def subject_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few exact subjects among very many: row groups without them are skipped."""
    wanted = ["events.click.11", "events.view.7", "events.none.0"]
    found = R.filter_subjects(_log(spark, sf_dir).scan(), wanted)
    return found.select("stream", "streamSeq", "subject")


def commit_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acks after a commit; committing again or an unknown batch changes nothing."""
    consumer = _consumer(spark, sf_dir)
    consumer.pull_batch("p1", _now(), fetch=60, listeners=2)
    acked = consumer.commit_batch("p1", _now())
    consumer.commit_batch("p1", _now())
    unknown = consumer.commit_batch("none", _now())
    return consumer.acks().select(
        "stream",
        "streamSeq",
        _us("acked_at"),
        F.lit(acked).cast("long").alias("committed"),
        F.lit(unknown).cast("long").alias("unknown"),
    )


def no_ack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without acks a delivered message is done: a later pull goes on after it although none was committed."""
    consumer = _consumer(spark, sf_dir, ack_none=True)
    consumer.pull_batch("p1", _now(), fetch=60, listeners=2)
    committed = consumer.commit_batch("p1", _now())
    much_later = _now() + F.expr("interval 1 day")
    second = consumer.pull_batch("p2", much_later, fetch=60, listeners=2)
    return second.select(
        "listener", "stream", "streamSeq", F.lit(committed).cast("long").alias("committed")
    )


# -- payloads ----------------------------------------------------------------------


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.table(spark, sf_dir, "documents").select("doc_id", E.utf8_bytes(F.col("text")).alias("content"))


def inflate_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = X.deflate(_payloads(spark, sf_dir), "content")
    return decode_payload(packed, "zlib").select("doc_id", _text("content", "text"))


def inflate_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth payload is not compressed and stays as it is."""
    plain = _payloads(spark, sf_dir)
    tenth = F.col("doc_id") % 10 == 0
    mixed = X.deflate(plain.where(~tenth), "content").unionByName(plain.where(tenth))
    decoded = decode_payload(mixed, "zlib", strict=False, flag="decoded_ok")
    return decoded.select("doc_id", _text("content", "text"), "decoded_ok")


def codec_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_payload(_payloads(spark, sf_dir), "none").select("doc_id", _text("content", "text"))


# -- publishing --------------------------------------------------------------------


def sink_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends; the second goes on where the first ended, and repeating it changes nothing."""
    log = X.new_log(spark, "sequence")
    messages = X.event_messages(spark, sf_dir)
    early = F.col("event_type").isin("purchase", "view")
    X.publish_events(log, messages.where(early), "one")
    X.publish_events(log, messages.where(~early), "two")
    X.publish_events(log, messages.where(~early), "two")
    return log.scan().select("stream", "streamSeq", "subject", _text("content"), _us("timestamp"))


def publish_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = X.new_log(spark, "publish")
    rows = X.event_messages(spark, sf_dir).select(
        "subject", E.iso_time(F.col("timestamp")).alias("dateTime"), F.col("data").alias("content")
    )
    total = publish_messages(log, rows, "OUT", "one")
    return log.scan().select(
        "stream",
        "subject",
        _text("content"),
        _header("originTimestamp", "origin"),
        F.lit(total).cast("long").alias("total"),
    )


def publish_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = X.new_log(spark, "texts")
    publish_text(log, X.table(spark, sf_dir, "conversations"), "CHAT", "chat.text", "text", "one")
    return log.scan().select(
        "stream", "subject", _text("content"), F.size("headers").cast("long").alias("n_headers")
    )


QUERIES = {
    f.__name__: f
    for f in (
        relay_rewrite,
        relay_partition_subject,
        envelope_full,
        reply_metadata,
        envelope_text5,
        envelope_text3,
        headers_map,
        headers_json,
        meta_json,
        message_json,
        time_formats,
        text_codecs,
        origin_header,
        legacy_sink,
        constant_columns,
        subject_exact,
        subject_wildcard,
        subject_patterns_join,
        stream_selection,
        non_null_messages,
        route_partitions,
        fanout_subjects,
        stream_guard,
        latest_offsets,
        range_scan,
        clamped_range,
        reset_start,
        batch_slices,
        listener_shares,
        next_fetch,
        pending,
        pending_counts,
        ack_floor,
        consumer_lag,
        delivery_counts,
        repeated_messages,
        distinct_messages,
        redelivery_due,
        inflight_capped,
        idle_gaps,
        pull_batch,
        pull_fair,
        subject_search,
        commit_batch,
        no_ack,
        inflate_strict,
        inflate_lenient,
        codec_none,
        sink_sequence,
        publish_batch,
        publish_texts,
    )
}
