import json
import os

import pytest
from pyspark.sql import functions as F

from msgflow.options import SourceOptions
from msgflow.session import scratch
from msgflow.sources.consumers import ConsumerStore
from msgflow.sources.msglog import PLAN_KEY, MessageLogStreamReader, bounded_ends, stream_ends
from msgflow.sources.reading import each_batch, read_stream
from tests.helpers import fill, keys


def reader(log, **options):
    return MessageLogStreamReader(
        SourceOptions.from_options({"path": log.path, "stream_prefix": "S", "num_partitions": 2, **options})
    )


def counted(partitions):
    return sum(s.upto - s.after for p in partitions for s in p.slices)


def test_streams_share_the_room():
    heads = {"a": 100, "b": 4, "c": 50, "d": 0}
    assert bounded_ends({}, heads, 1000) == heads
    assert bounded_ends({}, heads, 24) == {"a": 10, "b": 4, "c": 10, "d": 0}
    assert bounded_ends({"a": 95, "b": 4}, heads, 24) == {"a": 100, "b": 4, "c": 19, "d": 0}
    for most in range(1, 160):
        ends = bounded_ends({}, heads, most)
        assert sum(ends.values()) == min(most, 154)


def test_batches_follow_each_other(spark, log):
    fill(log, 100, streams=2)
    own = reader(log, max_batch_rows=30)
    at, seen = own.initialOffset(), []
    while (end := own.latestOffset()) != at:
        seen.append(counted(own.partitions(at, end)))
        at = end
    assert seen == [30, 30, 30, 10] and stream_ends(at) == log.heads()
    assert own.latestOffset() == at  # nothing new, no new offset


def test_a_restarted_reader_plans_from_where_spark_stands(spark, log):
    fill(log, 100, streams=2)
    first = reader(log, max_batch_rows=30)
    start, end = first.initialOffset(), first.latestOffset()
    first.partitions(start, end)
    second = reader(log, max_batch_rows=30)
    planned = second.latestOffset()  # before Spark has said anything
    assert [k for k in planned if k.startswith(PLAN_KEY)] and not stream_ends(planned)
    assert counted(second.partitions(end, planned)) == 30
    assert stream_ends(planned) == {"S-0": 30, "S-1": 30}
    # A crash before the batch is done: it is planned again as it was, whatever has come since.
    fill(log, 60, streams=2, batch="more")
    third = reader(log, max_batch_rows=50)
    assert counted(third.partitions(end, planned)) == 30
    following = third.latestOffset()
    assert counted(third.partitions(planned, following)) == 50
    assert stream_ends(following) == {"S-0": 55, "S-1": 55}


def test_a_restart_without_news_gives_one_empty_batch(spark, log):
    fill(log, 10, streams=2)
    first = reader(log, max_batch_rows=30)
    end = first.latestOffset()
    first.partitions(first.initialOffset(), end)
    second = reader(log, max_batch_rows=30)
    planned = second.latestOffset()
    assert second.partitions(end, planned) == [] and second.latestOffset() == planned


def test_all_messages_once_over_restarts(spark, log):
    fill(log, 90, streams=2)
    folder, checkpoint, sizes = scratch(spark, "o"), scratch(spark, "c"), []

    def keep(batch, batch_id):
        rows = batch.stored().select("stream", "streamSeq")
        sizes.append(rows.count())
        rows.write.mode("overwrite").parquet(f"{folder}/b{batch_id}")

    source = {"path": log.path, "stream_prefix": "S", "num_partitions": 2, "max_batch_rows": 25, "consumer": "c"}
    for run in range(3):
        writer = each_batch(spark, source, keep).option("checkpointLocation", checkpoint)
        if run < 2:
            writer.trigger(availableNow=True).start().awaitTermination()  # a single batch
            fill(log, 20, streams=2, batch=f"more{run}")
        else:
            query = writer.start()
            query.processAllAvailable()
            query.stop()
    assert keys(spark.read.parquet(f"{folder}/*")) == keys(log.scan())
    assert max(sizes) <= 25 and len(sizes) == 6
    # Taking back the last commit replays the same batch.
    last = max(int(n) for n in os.listdir(f"{checkpoint}/commits") if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        os.remove(f"{checkpoint}/commits/{name}")
    query = each_batch(spark, source, keep).option("checkpointLocation", checkpoint).start()
    query.processAllAvailable()
    query.stop()
    assert keys(spark.read.parquet(f"{folder}/*")) == keys(log.scan())


def test_consumer_moves_with_bounded_batches(spark, log):
    fill(log, 50)
    source = {"path": log.path, "stream": "S-0", "max_batch_rows": 20, "consumer": "c"}
    writer = each_batch(spark, source, lambda batch, i: None).option("checkpointLocation", scratch(spark, "c"))
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    for _ in range(100):
        if ConsumerStore(log.path, "c").floors():
            break
        import time

        time.sleep(0.1)
    assert ConsumerStore(log.path, "c").floors() == {"S-0": 20}


def test_envelope_of_a_batch_equals_the_source(spark, log):
    fill(log, 40, streams=2)
    options = {"path": log.path, "stream_prefix": "S", "num_partitions": 2, "consumer": "c", "domain": "d", "account": "a"}
    got = []
    each_batch(spark, options, lambda batch, i: got.extend(batch.messages().collect())).option(
        "checkpointLocation", scratch(spark, "c")
    ).trigger(availableNow=True).start().awaitTermination()
    folder = scratch(spark, "o")
    stream = read_stream(spark, **{**options, "consumer": "d"})
    stream.writeStream.format("parquet").option("path", folder).option("checkpointLocation", scratch(spark, "c")).trigger(
        availableNow=True
    ).start().awaitTermination()
    want = spark.read.schema(stream.schema).parquet(folder).withColumn("consumer", F.lit("c"))
    want = want.withColumn("replyTo", F.expr("replace(replyTo, '.d.1.', '.c.1.')"))
    key = lambda r: (r.stream, r.streamSeq)
    assert sorted(map(repr, sorted(got, key=key))) == sorted(map(repr, sorted(want.collect(), key=key)))


def test_idle_limit_holds_after_a_restart(spark, log):
    fill(log, 5)
    checkpoint = scratch(spark, "c")

    def start():
        stream = read_stream(spark, path=log.path, stream="S-0", idle_timeout=0.03)
        return stream.writeStream.format("noop").option("checkpointLocation", checkpoint).start()

    for _ in range(2):  # the second run gets no message at all
        query = start()
        assert query.awaitTermination(30)


def test_idle_limit_holds_on_an_empty_log(spark, log):
    stream = read_stream(spark, path=log.path, stream="none", idle_timeout=0.03)
    query = stream.writeStream.format("noop").option("checkpointLocation", scratch(spark, "c")).start()
    assert query.awaitTermination(30)


def test_reset_and_limit_exclude_each_other(log):
    with pytest.raises(ValueError, match="exclude"):
        reader(log, max_batch_rows=5, reset_on_restart="true")


def test_plan_is_a_small_file_of_the_log(spark, log):
    fill(log, 10, streams=2)
    own = reader(log, max_batch_rows=4)
    end = own.latestOffset()
    own.partitions({}, end)
    (path,) = (k.removeprefix(PLAN_KEY) for k in end if k.startswith(PLAN_KEY))
    with open(path) as f:
        assert path.startswith(log.path) and json.load(f) == {"S-0": 2, "S-1": 2}
