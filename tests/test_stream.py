import os
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from msgflow import schemas
from msgflow.operators.delivery import Delivery
from msgflow.options import SourceOptions
from msgflow.session import scratch, state_partitions
from msgflow.sources.consumers import ConsumerStore
from msgflow.sources.log import MessageLog
from msgflow.sources.msglog import MessageLogStreamReader, plan_slices, share_slices, slice_rows
from msgflow.sources.reading import read_stream
from msgflow.sources.sink import publish, write_stream
from msgflow.streaming.idle import stop_when_idle
from msgflow.streaming.relay import relay_rows, relay_stream
from msgflow.streaming.redelivery import redeliveries
from msgflow.streaming.stateful import dedupe, windowed_counts
from tests.helpers import fill, keys


def reader(log, **options):
    return MessageLogStreamReader(SourceOptions.from_options({"path": log.path, "stream": "S-0", **options}))


def run(writer, checkpoint):
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def collect(spark, stream, folder, checkpoint):
    run(stream.writeStream.format("parquet").option("path", folder), checkpoint)
    return spark.read.schema(stream.schema).parquet(folder)


def seqs(partitions):
    return sorted(n for p in partitions for s in p.slices for n in range(s.after + 1, s.upto + 1))


# -- planning on the driver --------------------------------------------------------


def test_slices_cover_a_range_once():
    files = [("f1", 1, 10, 10), ("f2", 11, 30, 20), ("f3", 31, 31, 1)]
    slices = plan_slices(files, "s", 4, 25, 7)
    assert [(s.file, s.after, s.upto) for s in slices] == [("f1", 4, 10), ("f2", 10, 17), ("f2", 17, 24), ("f2", 24, 25)]
    assert all(s.upto - s.after <= 7 for s in slices)


def test_many_slices_share_partitions_and_listeners_split_them():
    slices = plan_slices([("f", 1, 1000, 1000)], "s", 0, 1000, 1)
    partitions = share_slices(slices, 3, 90)
    assert len(partitions) <= 93
    assert seqs(partitions) == list(range(1, 1001))
    per_listener = [seqs([p for p in partitions if p.listener == n]) for n in range(3)]
    assert sum(map(len, per_listener)) == 1000 and all(len(p) > 300 for p in per_listener)


def test_partition_size_grows_only_when_needed():
    options = SourceOptions.from_options(
        {"path": "/p", "stream": "s", "batch_size": 10, "partition_rows": 10, "max_partitions": 100}
    )
    assert slice_rows(500, options) == 10
    assert slice_rows(10**12, options) == 10**10


def test_offsets_come_from_the_log(spark, log):
    source = reader(log)
    assert source.initialOffset() == {"S-0": 0} and source.latestOffset() == {"S-0": 0}
    fill(log, 10, batch="b0")
    assert source.latestOffset() == {"S-0": 10}
    fill(log, 5, batch="b1")
    assert source.latestOffset() == reader(log).latestOffset() == {"S-0": 15}
    assert seqs(source.partitions({"S-0": 3}, {"S-0": 12})) == list(range(4, 13))
    assert source.partitions({"S-0": 12}, {"S-0": 12}) == []
    assert seqs(source.partitions({}, {"S-0": 999})) == list(range(1, 16))  # clamped to the last message


@pytest.mark.parametrize("bad", [{"S-0": -1}, {"S-0": "x"}, None])
def test_invalid_offsets(spark, log, bad):
    with pytest.raises(ValueError, match="offset"):
        reader(log).partitions({"S-0": 0}, bad)


def test_batch_size_slices(spark, log):
    fill(log, 25)
    partitions = reader(log, batch_size=10, partition_rows=10).partitions({"S-0": 0}, {"S-0": 25})
    assert all(len(seqs([p])) <= 10 for p in partitions) and seqs(partitions) == list(range(1, 26))


def test_reset_applies_to_the_first_real_batch_only(spark, log):
    fill(log, 10)
    source = reader(log, reset_on_restart="true")
    assert source.partitions({"S-0": 4}, {"S-0": 4}) == []
    assert seqs(source.partitions({"S-0": 4}, {"S-0": 6})) == [1, 2, 3, 4, 5, 6]
    assert seqs(source.partitions({"S-0": 6}, {"S-0": 8})) == [7, 8]


def test_durable_consumer_position(spark, log):
    fill(log, 50)
    source = reader(log, consumer="c", max_ack_pending=20)
    tag = {f"consumer:{log.path}/consumers/c": 0}
    assert source.initialOffset() == {"S-0": 0} | tag and source.latestOffset() == {"S-0": 50} | tag
    source.commit({"S-0": 20} | tag)
    again = reader(log, consumer="c", create_consumer="false")
    assert again.initialOffset() == {"S-0": 20} | tag and again.latestOffset() == {"S-0": 50} | tag
    assert seqs(again.partitions({"S-0": 30}, {"S-0": 50})) == list(range(31, 51))
    assert ConsumerStore(log.path, "c").floors() == {"S-0": 30}  # planning from an offset means all before it is done
    assert reader(log, consumer="c", ack_none="true").latestOffset() == {"S-0": 50}
    with pytest.raises(ValueError, match="'new'"):
        reader(log, consumer="new", create_consumer="false")


def test_no_ack_consumer_keeps_no_position(spark, log):
    fill(log, 5)
    source = reader(log, consumer="c", ack_none="true")
    source.commit({"S-0": 5})
    assert ConsumerStore(log.path, "c").floors() == {}


# -- running -----------------------------------------------------------------------


def test_envelope_of_the_source(spark, log):
    fill(log, 30, streams=2)
    stream = read_stream(spark, path=log.path, stream_prefix="S", num_partitions=2, domain="d", account="a", consumer="c")
    assert [(f.name, f.dataType) for f in stream.schema] == [(f.name, f.dataType) for f in schemas.ENVELOPE]
    out = collect(spark, stream, scratch(spark, "o"), scratch(spark, "c"))
    assert keys(out) == keys(log.scan())
    row = out.where("stream = 'S-1' and streamSeq = 4").collect()[0]
    assert row.replyTo.startswith("$JS.ACK.d.a.S-1.c.1.4.4.") and row.replyTo.endswith(".11")
    assert (row.domain, row.consumer, row.delivered, row.consumerSeq, row.pending) == ("d", "c", 1, 4, 11)
    assert bytes(row.content) == b"number 7" and row.headers is None


def test_chosen_columns_only(spark, log):
    fill(log, 5)
    names = ["pending", "replyTo", "streamSeq"]
    stream = read_stream(spark, path=log.path, stream="S-0", columns=",".join(names))
    assert stream.columns == names
    rows = collect(spark, stream, scratch(spark, "o"), scratch(spark, "c")).orderBy("streamSeq").collect()
    assert [(r.streamSeq, r.pending) for r in rows] == [(n, 5 - n) for n in range(1, 6)]
    assert all(r.replyTo.startswith("$JS.ACK") for r in rows)
    with pytest.raises(Exception, match="Unknown envelope columns: nope"):
        read_stream(spark, path=log.path, stream="S-0", columns="nope")
    with pytest.raises(ValueError, match="full envelopes"):
        read_stream(spark, path=log.path, stream="S-0", columns="subject", envelope="text3")


def test_restart_has_no_gap_and_no_repeat(spark, log):
    folder, checkpoint = scratch(spark, "o"), scratch(spark, "c")
    stream = read_stream(spark, path=log.path, stream="S-0").select("stream", "streamSeq")
    for n, batch in ((7, "b0"), (0, "b1"), (5, "b2")):
        fill(log, n, batch=batch)
        out = collect(spark, stream, folder, checkpoint)
    assert keys(out) == [("S-0", n) for n in range(1, 13)]


def test_text_envelopes_of_the_source(spark, log):
    fill(log, 3)
    five = read_stream(spark, path=log.path, stream="S-0", envelope="text5", datetime_format="yyyy")
    assert five.columns == schemas.TEXT5.names
    rows = collect(spark, five, scratch(spark, "o"), scratch(spark, "c")).collect()
    assert {r.dateTime for r in rows} <= {str(time.gmtime().tm_year), str(time.gmtime().tm_year - 1)}
    three = read_stream(spark, path=log.path, stream="S-0", envelope="text3")
    assert three.columns == schemas.TEXT3.names
    with pytest.raises(Exception, match="full envelopes"):
        stream = spark.readStream.format("msglog").options(path=log.path, stream="S-0", envelope="text5").load()
        run(stream.writeStream.format("noop"), scratch(spark, "c"))


def test_codec_of_the_source(spark, log):
    import zlib

    from msgflow.sources.sink import publish

    rows = [("z", bytearray(zlib.compress(b"packed"))), ("z", bytearray(b"plain"))]
    publish(log, spark.createDataFrame(rows, "subject string, data binary"), "S-0", "b")
    lenient = read_stream(spark, path=log.path, stream="S-0", codec="zlib", strict="false").select("content")
    got = {bytes(r.content) for r in collect(spark, lenient, scratch(spark, "o"), scratch(spark, "c")).collect()}
    assert got == {b"packed", b"plain"}
    strict = read_stream(spark, path=log.path, stream="S-0", codec="zlib").select("content")
    with pytest.raises(Exception, match="zlib|incorrect header"):
        collect(spark, strict, scratch(spark, "o"), scratch(spark, "c"))


def test_relay_acks_and_replay(spark, log):
    fill(log, 20, streams=2)
    target, checkpoint = scratch(spark, "t"), scratch(spark, "c")
    source = {"path": log.path, "stream_prefix": "S", "num_partitions": 2, "consumer": "c"}
    writer = lambda: relay_stream(
        spark, source, {"path": target, "stream": "OUT", "subjects": "done.>"}, r"(.+)", "done.$1"
    )
    run(writer(), checkpoint)
    out = MessageLog(spark, target)
    assert out.scan().count() == 20 and {r.subject for r in out.scan().collect()} == {"done.s.a"}
    consumer = Delivery(log, "c")
    assert keys(consumer.acks()) == keys(log.scan())
    assert consumer.floors() == {"S-0": 10, "S-1": 10}
    # Nothing is left for the consumer, whatever the checkpoint.
    run(writer(), scratch(spark, "c"))
    assert MessageLog(spark, target).scan().count() == 20


def test_replayed_batch_is_appended_once(spark, log):
    """The last commit is taken back, as after a crash between the append and the checkpoint commit."""
    fill(log, 20)
    target, checkpoint = scratch(spark, "t"), scratch(spark, "c")
    writer = lambda: relay_stream(
        spark, {"path": log.path, "stream": "S-0"}, {"path": target, "stream": "OUT"}, r"(.+)", "done.$1"
    )
    run(writer(), checkpoint)
    for name in ("0", ".0.crc"):
        os.remove(f"{checkpoint}/commits/{name}")
    run(writer(), checkpoint)
    assert MessageLog(spark, target).scan().count() == 20
    # A query on a new checkpoint is another writer: its batches are not taken for replays.
    run(writer(), scratch(spark, "c"))
    assert MessageLog(spark, target).scan().count() == 40


def test_relay_refuses_foreign_subjects(spark, log):
    fill(log, 5)
    writer = relay_stream(
        spark,
        {"path": log.path, "stream": "S-0"},
        {"path": scratch(spark, "t"), "stream": "OUT", "subjects": "other.>"},
        r"(.+)",
        "done.$1",
    )
    with pytest.raises(Exception, match="is not in stream 'OUT'"):
        run(writer, scratch(spark, "c"))


def test_typed_sink_from_a_stream_and_console(spark, log, capfd):
    fill(log, 6)
    target = scratch(spark, "t")
    rows = relay_rows(read_stream(spark, path=log.path, stream="S-0"), r"(.+)", "copy.$1")
    run(write_stream(rows, path=target, stream="COPY"), scratch(spark, "c"))
    assert keys(MessageLog(spark, target).scan()) == [("COPY", n) for n in range(1, 7)]
    shown = rows.select("subject").writeStream.format("console").outputMode("append")
    run(shown, scratch(spark, "c"))


def test_idle_query_is_stopped(spark, log):
    fill(log, 3)
    stream = read_stream(spark, path=log.path, stream="S-0")
    query = (
        stream.writeStream.format("noop").option("checkpointLocation", scratch(spark, "c"))
        .trigger(processingTime="200 milliseconds").start()
    )
    listener = stop_when_idle(spark, query, minutes=0.05)
    try:
        assert query.awaitTermination(90)
    finally:
        spark.streams.removeListener(listener)
        query.stop()


def file_stream(spark, df):
    folder = scratch(spark, "in")
    df.coalesce(1).write.parquet(folder)
    return spark.readStream.schema(df.schema).parquet(folder)


def stamped(spark, rows, time_column):
    df = spark.createDataFrame(rows, "stream string, streamSeq bigint, t string")
    return df.select(F.lit("c").alias("consumer"), "stream", "streamSeq", F.col("t").cast("timestamp").alias(time_column))


def test_watermark_holds_open_windows(spark):
    rows = [("s", 1, "2024-01-01 00:00:10"), ("s", 2, "2024-01-01 00:00:50"), ("s", 3, "2024-01-01 00:02:30")]
    stream = file_stream(spark, stamped(spark, rows, "timestamp"))
    counts = windowed_counts(stream, "1 minute", "1 minute").select(F.col("window.start").cast("string").alias("w"), "messages")
    with state_partitions(spark):
        out = collect(spark, counts, scratch(spark, "o"), scratch(spark, "c"))
    assert [tuple(r) for r in out.collect()] == [("2024-01-01 00:00:00", 2)]


def test_stream_dedupe(spark):
    rows = [("s", 1, "2024-01-01 00:00:00"), ("s", 1, "2024-01-01 00:00:30"), ("s", 2, "2024-01-01 00:00:00")]
    out = dedupe(file_stream(spark, stamped(spark, rows, "delivered_at")), "delivered_at", "10 minutes")
    assert keys(collect(spark, out, scratch(spark, "o"), scratch(spark, "c"))) == [("s", 1), ("s", 2)]


def test_stream_redelivery(spark):
    far = ("beat", 0, "2024-01-02 00:00:00")
    deliveries = [("s", n, "2024-01-01 00:00:00") for n in (1, 2, 3)] + [far]
    acks = [("s", 1, "2024-01-01 00:01:30"), ("s", 2, "2024-01-01 00:01:31"), far]
    due = redeliveries(
        file_stream(spark, stamped(spark, deliveries, "delivered_at")), file_stream(spark, stamped(spark, acks, "acked_at")), 90
    )
    assert keys(collect(spark, due, scratch(spark, "o"), scratch(spark, "c"))) == [("s", 2), ("s", 3)]


def wait_for(test, seconds=20):
    until = time.monotonic() + seconds
    while not test() and time.monotonic() < until:
        time.sleep(0.05)
    return test()


def test_default_consumer_gets_and_acknowledges_everything(spark, log):
    fill(log, 3000)
    stream = read_stream(spark, path=log.path, stream="S-0", consumer="c", columns="stream,streamSeq")
    out = collect(spark, stream, scratch(spark, "o"), scratch(spark, "c"))
    assert out.count() == 3000
    assert wait_for(lambda: ConsumerStore(log.path, "c").floors() == log.heads())


def test_filtered_consumer_is_not_held_up(spark, log):
    fill(log, 3000, batch="b0", subject="x.miss")
    fill(log, 5, batch="b1", subject="x.hit")
    fill(log, 10, batch="b2", subject="x.miss")
    target = scratch(spark, "t")
    source = {"path": log.path, "stream": "S-0", "consumer": "c", "subjects": "x.hit"}
    run(relay_stream(spark, source, {"path": target, "stream": "OUT"}, r"(.+)", "done.$1"), scratch(spark, "c"))
    assert MessageLog(spark, target).scan().count() == 5
    assert wait_for(lambda: ConsumerStore(log.path, "c").floors() == log.heads())


def test_idle_option_stops_the_query(spark, log):
    fill(log, 5)
    stream = read_stream(spark, path=log.path, stream="S-0", idle_timeout=0.03)
    query = stream.writeStream.format("noop").option("checkpointLocation", scratch(spark, "c")).start()
    assert query.awaitTermination(60)


def test_format_as_a_table(spark, log):
    from msgflow.sources.reading import register

    register(spark)
    fill(log, 30, streams=2)
    table = spark.read.format("msglog").options(path=log.path, stream_prefix="S", num_partitions="2").load()
    assert keys(table) == keys(log.scan()) and table.columns == schemas.ENVELOPE.names
    empty = spark.read.format("msglog").options(path=log.path, stream="none").load()
    assert empty.count() == 0


# -- memory of the source ----------------------------------------------------------


def read_all(source, start, end):
    return [b for p in source.partitions(start, end) for b in source.read(p)]


@pytest.mark.parametrize("different", [3, 400])
def test_source_reads_a_row_group_in_parts(spark, log, different):
    """40 MB in a row group, also if the payloads are few that repeat."""
    blobs = [os.urandom(100_000) for _ in range(3)]
    data = F.element_at(F.array(*[F.lit(b) for b in blobs]), (F.col("id") % 3 + 1).cast("int"))
    tail = F.encode((F.col("id") % different).cast("string"), "UTF-8")
    none = F.lit(None).cast("map<string,array<string>>").alias("headers")
    rows = spark.range(0, 400, 1, 1).select("id", F.lit("s.a").alias("subject"), F.concat(data, tail).alias("data"), none)
    publish(log, rows, "S-0", "b0", order_by=["id"])
    source = reader(log, columns="streamSeq,content")
    before, held, got = pa.total_allocated_bytes(), 0, []
    for partition in source.partitions({}, {"S-0": 400}):
        for batch in source.read(partition):
            held = max(held, pa.total_allocated_bytes() - before)
            assert batch.nbytes <= 5 << 20
            got += batch.to_pylist()
            del batch
    assert held < 24 << 20
    want = [{"streamSeq": i + 1, "content": blobs[i % 3] + str(i % different).encode()} for i in range(400)]
    assert sorted(got, key=lambda r: r["streamSeq"]) == want


def test_range_over_row_groups_and_subjects_without_their_column(spark, log):
    fill(log, 150_000)
    fill(log, 1000, batch="b1", subject="s.b")
    found = read_all(reader(log, columns="streamSeq"), {"S-0": 65_000}, {"S-0": 131_100})
    assert sorted(n for b in found for n in b.column("streamSeq").to_pylist()) == list(range(65_001, 131_101))
    found = read_all(reader(log, subjects="s.b", columns="stream,streamSeq"), {"S-0": 149_000}, {"S-0": 150_700})
    assert sorted(n for b in found for n in b.column("streamSeq").to_pylist()) == list(range(150_001, 150_701))
    assert {b.schema.names[0] for b in found} == {"stream"}
