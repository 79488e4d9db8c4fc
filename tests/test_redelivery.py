import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from msgflow.session import scratch, state_partitions
from msgflow.streaming import redelivery as R
from msgflow.streaming.redelivery import redeliver, redeliveries

WAIT = 90


def plain(deliveries, acks, resend, most, horizon):
    """What is given out, from the definition: every wait that ends by the horizon without an ack up to its end."""
    first = {}
    for seq, at in acks:
        first[seq] = min(at, first.get(seq, at))
    out = []
    for seq, at, attempt in deliveries:
        while at + WAIT <= horizon and not first.get(seq, horizon + WAIT + 1) <= at + WAIT:
            if not resend:
                out.append((seq, at, attempt))
                break
            at, attempt = at + WAIT, attempt + 1
            if attempt > most:
                break
            out.append((seq, at, attempt))
    return sorted(out)


@pytest.mark.parametrize("resend", [False, True])
@pytest.mark.parametrize("seed", range(6))
def test_block_in_steps_of_the_watermark(seed, resend):
    """Whatever the cut into batches, as long as nothing comes later than the watermark, the rows are the same."""
    r = random.Random(seed)
    deliveries = [(s, r.randrange(3000), 1 + k) for s in range(40) for k in range(r.randrange(1, 4))]
    acks = [(s, r.randrange(4000)) for s in range(40) for _ in range(r.randrange(3))]
    events = sorted([(at, "d", (s, at, n)) for s, at, n in deliveries] + [(at, "a", (s, at)) for s, at in acks])
    acked, recent, waiting = np.zeros(R.BLOCK // 8, np.uint8), np.zeros(0, R.ACKED), np.zeros(0, R.WAITING)
    out, done, watermark = [], 0, -1
    while watermark < 6000:
        step = r.randrange(1, 12)
        part, done = events[done : done + step], done + step
        later = events[done][0] if done < len(events) else 6001
        recent = np.concatenate([recent, np.array([e[2] for e in part if e[1] == "a"], R.ACKED)])
        waiting = np.concatenate([waiting, np.array([e[2] for e in part if e[1] == "d"], R.WAITING)])
        watermark = min(later - 1, 6000)
        acked, recent, waiting, rows = R.settle(acked, recent, waiting, watermark, WAIT, resend, 7)
        out += [tuple(x) for x in rows.tolist()]
    assert sorted(out) == plain(deliveries, acks, resend, 7, 6000)


def test_settled_block_keeps_only_bits():
    waiting = np.array([(5, 0, 1)], R.WAITING)
    recent = np.array([(5, 10), (6, 20)], R.ACKED)
    acked, recent, waiting, out = R.settle(np.zeros(R.BLOCK // 8, np.uint8), recent, waiting, 100, WAIT, True, 9)
    assert not len(recent) and not len(waiting) and not len(out)
    assert np.flatnonzero(np.unpackbits(acked, bitorder="little")).tolist() == [5, 6]


def stream_of(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def add(spark, folder, rows, time, more=""):
    fields = "consumer string, stream string, streamSeq long, " + more + f"{time} string"
    df = spark.createDataFrame([("c", "s", *x) for x in rows], fields)
    df.withColumn(time, F.to_timestamp(time)).coalesce(1).write.mode("append").parquet(folder)


def at(minute, second=0, day=1):
    return f"2024-01-{day:02d} 00:{minute:02d}:{second:02d}"


def run(spark, df, folder, checkpoint):
    with state_partitions(spark):
        query = df.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint)
        query.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(folder)


def rows_of(df):
    return sorted((r.streamSeq, r.attempt, r.delivered_at.strftime("%d %H:%M:%S")) for r in df.collect())


def test_sent_again_until_acknowledged_also_after_a_restart(spark):
    d, a, out, ck = (scratch(spark, n) for n in "daoc")
    add(spark, d, [(1, at(0)), (2, at(0)), (5000, at(0))], "delivered_at")
    add(spark, a, [(1, at(1)), (9, at(0))], "acked_at")
    deliveries = stream_of(spark, d, "consumer string, stream string, streamSeq long, delivered_at timestamp")
    acks = stream_of(spark, a, "consumer string, stream string, streamSeq long, acked_at timestamp")
    again = redeliver(deliveries, acks, WAIT, max_deliver=4, delay="0 seconds")
    run(spark, again, out, ck)
    # Number 2 is acknowledged after its second delivery, 5000 never; then the clock moves on.
    add(spark, a, [(2, at(2)), (9, at(30))], "acked_at")
    add(spark, d, [(9, at(30))], "delivered_at")
    got = rows_of(run(spark, again, out, ck))
    assert got == [(2, 2, "01 00:01:30"), (5000, 2, "01 00:01:30"), (5000, 3, "01 00:03:00"), (5000, 4, "01 00:04:30")]


def test_ack_of_long_ago_counts(spark):
    d, a = (scratch(spark, n) for n in "da")
    add(spark, d, [(1, 1, at(0)), (2, 1, at(0)), (1, 2, at(0, day=9)), (2, 2, at(0, day=9)), (9, 1, at(0, day=20))], "delivered_at", "attempt long, ")
    add(spark, a, [(1, at(1)), (9, at(0, day=20))], "acked_at")
    deliveries = stream_of(spark, d, "consumer string, stream string, streamSeq long, attempt long, delivered_at timestamp")
    acks = stream_of(spark, a, "consumer string, stream string, streamSeq long, acked_at timestamp")
    due = redeliveries(deliveries, acks, WAIT)
    assert rows_of(run(spark, due, scratch(spark, "o"), scratch(spark, "c"))) == [(2, 1, "01 00:00:00"), (2, 2, "09 00:00:00")]


def test_state_store_of_the_user_is_kept(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.getAll.get(key)
    spark.conf.set(key, "some.Provider")
    try:
        R.use_timers(spark)
        assert spark.conf.get(key) == "some.Provider"
        spark.conf.unset(key)
        R.use_timers(spark)
        assert spark.conf.get(key).endswith("RocksDBStateStoreProvider")
    finally:
        spark.conf.unset(key)
        if before:
            spark.conf.set(key, before)
