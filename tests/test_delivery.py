import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from msgflow.operators import delivery as D
from msgflow.operators import ranking
from msgflow.session import scratch
from tests.helpers import fill, keys

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return F.lit(T0 + dt.timedelta(seconds=seconds)).cast("timestamp")


def heads(spark, **known):
    return spark.createDataFrame(sorted(known.items()), "stream string, head bigint")


def acks_frame(spark, rows):
    return spark.createDataFrame(rows, "stream string, streamSeq bigint")


def brute_floor(numbers):
    n = 0
    while n + 1 in numbers:
        n += 1
    return n


CASES = {
    "none": [],
    "first": [1],
    "hole-at-1": [2, 3],
    "hole-at-10": [*range(1, 10), 11],
    "span-minus-1": range(1, 32767),
    "span": range(1, 32768),
    "span-plus-1": range(1, 32769),
    "two-spans": range(1, 65536),
    "long": range(1, 70001),
    "hole-inside": [n for n in range(1, 70001) if n != 40000],
    "hole-at-span-end": [n for n in range(1, 100001) if n != 32767],
    "hole-at-span-start": [n for n in range(1, 100001) if n != 32768],
    "late-start": range(2, 70001),
}


@pytest.fixture(scope="module")
def case_acks(spark):
    """All cases as streams of one table, with some acks repeated."""
    folder = scratch(spark, "case-acks")
    frames = [
        pd.DataFrame({"stream": s, "streamSeq": pd.Series([*numbers, *numbers[:50]], dtype="int64")})
        for s, numbers in CASES.items()
    ]
    spark.createDataFrame(pd.concat(frames), "stream string, streamSeq bigint").write.parquet(folder)
    return spark.read.parquet(folder)


@pytest.mark.parametrize("earlier", [None, 0.0, 0.3, 0.5, 0.9, 1.0])
def test_ack_floor_lag_and_pending(spark, case_acks, earlier):
    """With and without floors known from before."""
    wanted = {name: brute_floor(set(numbers)) for name, numbers in CASES.items()}
    floors = None if earlier is None else {s: int(f * earlier) for s, f in wanted.items()}
    known = heads(spark, **dict.fromkeys(CASES, 100_000))
    got = {r.stream: (r.ack_floor, r.lag) for r in D.ack_floors(known, case_acks, floors).collect()}
    assert got == {s: (f, 100_000 - f) for s, f in wanted.items()}
    left = {r.stream: r.pending for r in D.pending_counts(known, case_acks, floors).collect()}
    assert left == {s: 100_000 - len(numbers) for s, numbers in CASES.items()}


def test_pending_messages_with_and_without_floors(spark, log):
    fill(log, 60, streams=2)
    acks = acks_frame(spark, [("S-0", n) for n in (1, 2, 3, 7)] + [("S-1", n) for n in range(1, 31)])
    expected = [("S-0", n) for n in range(4, 31) if n != 7]
    assert keys(D.pending_messages(log.scan(), acks)) == expected
    assert keys(D.pending_messages(log.scan(), acks, {"S-0": 3, "S-1": 30})) == expected


def test_acked_and_pending_make_up_the_log(spark, log):
    fill(log, 200, streams=3)
    rng = random.Random(4)
    chosen = [k for k in keys(log.scan()) if rng.random() < 0.4]
    pending = keys(D.pending_messages(log.scan(), acks_frame(spark, chosen * 3)))
    assert sorted(pending + chosen) == keys(log.scan())


@pytest.mark.parametrize("limit", [1000, 3], ids=["window", "buckets"])
@pytest.mark.parametrize("listeners", [None, 1, 3])
def test_first_unacked_against_brute_force(spark, log, monkeypatch, limit, listeners):
    monkeypatch.setattr(ranking, "MAP_SIDE_LIMIT", limit)
    fill(log, 300, streams=2)
    rng = random.Random(9)
    everything = keys(log.scan())
    acked = [k for k in everything if rng.random() < 0.5]
    floors = {"S-0": brute_floor({n for s, n in acked if s == "S-0"})}
    left = [k for k in everything if k not in set(acked)]
    expected = []
    if listeners is None:
        for s in ("S-0", "S-1"):
            expected += [k for k in left if k[0] == s][:7]
    else:
        for share in range(listeners):
            own = sorted((n, s) for s, n in left if n % listeners == share)[:7]
            expected += [(s, n) for n, s in own]
    got = D.first_unacked(log.scan(), acks_frame(spark, acked), floors, 7, listeners)
    assert keys(got) == sorted(expected)


def test_first_unacked_with_subjects(spark, log):
    fill(log, 50, batch="b0", subject="s.a")
    fill(log, 50, batch="b1", subject="s.b")
    got = D.first_unacked(log.scan(), acks_frame(spark, [("S-0", 51)]), {}, 5, 1, ("s.b",))
    assert keys(got) == [("S-0", n) for n in range(52, 57)]


def test_in_flight_cap(spark, log):
    fill(log, 30)
    acks = acks_frame(spark, [("S-0", n) for n in (1, 2, 4, 6)])
    assert keys(D.inflight_capped(log.scan(), acks, {"S-0": 2}, 3)) == [("S-0", 3), ("S-0", 5), ("S-0", 7)]


def test_redelivery(spark):
    deliveries = spark.createDataFrame(
        [
            ("c", "s", 1, T0),  # acked in time
            ("c", "s", 2, T0),  # never acked
            ("c", "s", 3, T0),  # acked too late
            ("c", "s", 4, T0 + dt.timedelta(seconds=80)),  # still within its wait
            ("c", "s", 5, T0),  # delivered twice, acked after the second
            ("c", "s", 5, T0 + dt.timedelta(seconds=90)),
        ],
        "consumer string, stream string, streamSeq bigint, delivered_at timestamp",
    )
    acked = [(1, 10), (1, 200), (3, 91), (5, 100)]
    acks = spark.createDataFrame(
        [("c", "s", n, T0 + dt.timedelta(seconds=s)) for n, s in acked],
        "consumer string, stream string, streamSeq bigint, acked_at timestamp",
    )
    due = D.redelivery_due(deliveries, acks, 90, at(100))
    assert sorted((r.streamSeq, r.attempts) for r in due.collect()) == [(2, 1)]
    # Before the late ack came, its message was due; a delivery or an ack of the future does not count.
    earlier = D.redelivery_due(deliveries, acks, 90, at(90))
    assert sorted((r.streamSeq, r.attempts) for r in earlier.collect()) == [(2, 1), (3, 1)]
    assert D.redelivery_due(deliveries, acks, 90, at(-1)).count() == 0
    # An ack that came before the last delivery ends the matter, too.
    assert [r.streamSeq for r in D.redelivery_due(deliveries, acks.where("streamSeq = 1"), 90, at(1000)).orderBy("streamSeq").collect()] == [2, 3, 4, 5]
    assert D.redelivery_due(deliveries, acks, 90, at(100), ack_none=True).count() == 0
    assert {r.streamSeq: r.delivered for r in D.delivery_counts(deliveries).collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 2}
    assert [(r.streamSeq, r.seen) for r in D.repeated_messages(deliveries).collect()] == [(5, 2)]
    assert D.drop_repeats(deliveries).count() == 5


def test_hot_message_does_not_multiply(spark):
    """One message delivered and acknowledged very often stays one row of the join."""
    hot = spark.range(30_000).select(
        F.lit("c").alias("consumer"), F.lit("s").alias("stream"), F.lit(1).cast("long").alias("streamSeq"), at(0).alias("t")
    )
    deliveries, acks = hot.withColumnRenamed("t", "delivered_at"), hot.withColumnRenamed("t", "acked_at")
    assert D.redelivery_due(deliveries, acks, 90, at(1000)).count() == 0
    assert D.delivery_counts(deliveries).collect()[0].delivered == 30_000


def test_idle_gaps(spark):
    times = [0, 60, 700, 701, 5000]
    rows = [("s", i + 1, T0 + dt.timedelta(seconds=t)) for i, t in enumerate(times)] + [("q", 1, T0)]
    df = spark.createDataFrame(rows, "stream string, streamSeq bigint, timestamp timestamp")
    got = [(r.streamSeq, r.gap_us) for r in D.idle_gaps(df, 10).orderBy("streamSeq").collect()]
    assert got == [(3, 640_000_000), (5, 4_299_000_000)]


def test_two_pulls_commits_and_an_empty_third(spark, log):
    """100 messages on each of two streams, two listeners."""
    fill(log, 200, streams=2)
    consumer = D.Delivery(log, "c")
    first = keys(consumer.pull_batch("p1", at(0), fetch=50, listeners=2))
    second = keys(consumer.pull_batch("p2", at(1), fetch=50, listeners=2))
    assert len(first) == len(second) == 100 and sorted(first + second) == keys(log.scan())
    assert consumer.commit_batch("p1", at(2)) == 100 and consumer.commit_batch("p2", at(2)) == 100
    assert keys(consumer.pull_batch("p3", at(3), fetch=50, listeners=2)) == []
    assert keys(consumer.pull_batch("p4", at(10_000), fetch=50, listeners=2)) == []
    assert consumer.advance_floors() == {"S-0": 100, "S-1": 100}


def test_unacked_messages_come_back_after_their_wait(spark, log):
    fill(log, 10)
    consumer = D.Delivery(log, "c")
    first = consumer.pull_batch("p1", at(0), fetch=4, ack_wait=90)
    assert keys(first) == [("S-0", n) for n in (1, 2, 3, 4)]
    assert keys(consumer.pull_batch("p2", at(89), fetch=4)) == [("S-0", n) for n in (5, 6, 7, 8)]
    back = consumer.pull_batch("p3", at(91), fetch=4)
    assert sorted((r.streamSeq, r.attempt) for r in back.collect()) == [(1, 2), (2, 2), (3, 2), (4, 2)]


def test_pull_and_commit_can_be_repeated(spark, log):
    fill(log, 10)
    consumer = D.Delivery(log, "c")
    assert keys(consumer.pull_batch("p1", at(0), fetch=4)) == keys(consumer.pull_batch("p1", at(0), fetch=4))
    assert consumer.commit_batch("p1", at(1)) == consumer.commit_batch("p1", at(9)) == 4
    assert consumer.acks().count() == consumer.acks().where(F.col("acked_at") == at(1)).count() == 4
    assert consumer.floors() == {"S-0": 4}
    assert consumer.commit_batch("unknown", at(1)) == 0
    assert keys(consumer.batch_messages("unknown")) == []


def test_no_ack_mode(spark, log):
    fill(log, 10)
    consumer = D.Delivery(log, "c", ack_none=True)
    consumer.pull_batch("p1", at(0), fetch=4)
    assert consumer.commit_batch("p1", at(1)) == 0
    assert keys(consumer.pull_batch("p2", at(100_000), fetch=4)) == [("S-0", n) for n in (5, 6, 7, 8)]


def test_consumers_do_not_see_each_other(spark, log):
    fill(log, 5)
    one, two = D.Delivery(log, "one"), D.Delivery(log, "two")
    one.pull_batch("p", at(0), fetch=5)
    one.commit_batch("p", at(1))
    assert len(keys(two.pull_batch("p", at(2), fetch=5))) == 5


def test_bad_consumer_name(spark, log):
    with pytest.raises(ValueError, match="consumer name"):
        D.Delivery(log, "a/b")


def test_consumer_settings(spark, log):
    fill(log, 20)
    consumer = D.Delivery(log, "c")
    with pytest.raises(ValueError, match="'c' does not exist"):
        consumer.store.open(create=False)
    consumer.store.open(create=True, ack_wait=5, max_request_batch=3)
    assert consumer.store.open(create=False)["ack_wait"] == 5
    with pytest.raises(ValueError, match="max_request_batch=3"):
        consumer.pull_batch("p", at(0), fetch=10)
    assert len(keys(consumer.pull_batch("p", at(0), fetch=3))) == 3
    consumer.store.open(create=True, ack_wait=6)
    assert consumer.store.settings()["ack_wait"] == 6
    assert consumer.store.advance({"S-0": 5}) == consumer.store.advance({"S-0": 4}) == {"S-0": 5}


def test_filtered_consumer_position(spark, log):
    fill(log, 5, batch="b0", subject="s.a")
    fill(log, 5, batch="b1", subject="s.b")
    fill(log, 5, batch="b2", subject="s.a")
    consumer = D.Delivery(log, "c")
    consumer.store.open(create=True, subjects=("s.b",))
    assert consumer.advance_floors() == {"S-0": 5}
    consumer.pull_batch("p", at(0), fetch=2, subjects=("s.b",))
    consumer.commit_batch("p", at(1))
    assert consumer.advance_floors() == {"S-0": 7}
    consumer.pull_batch("q", at(2), fetch=9, subjects=("s.b",))
    consumer.commit_batch("q", at(3))
    assert consumer.advance_floors() == {"S-0": 15}


def test_cap_on_unacknowledged_messages_over_pulls(spark, log):
    fill(log, 30, streams=2)
    consumer = D.Delivery(log, "c")
    consumer.store.open(create=True, ack_wait=60, max_ack_pending=7)
    # Seven per stream: three and two, two and three, then two and two are left.
    assert len(keys(consumer.pull_batch("p1", at(0), fetch=5))) == 5
    assert len(keys(consumer.pull_batch("p2", at(1), fetch=5))) == 5
    assert len(keys(consumer.pull_batch("p3", at(2), fetch=5))) == 4
    assert len(keys(consumer.pull_batch("none", at(2), fetch=5))) == 0
    consumer.commit_batch("p1", at(3))
    assert consumer.floors() == {"S-0": 3, "S-1": 2}
    assert len(keys(consumer.pull_batch("p4", at(4), fetch=20, listeners=2))) == 5
    assert len(keys(consumer.pull_batch("p5", at(62), fetch=20))) == 9  # the second and third pulls' waits are over


def test_a_stream_at_its_cap_leaves_the_pull_to_others(spark, log):
    """One stream with everything open, one with half of it acknowledged, room for ten each, pulls of ten."""
    fill(log, 200, streams=2)
    consumer = D.Delivery(log, "c")
    consumer.store.open(create=True, ack_wait=60, max_ack_pending=10)
    consumer.write_acks(log.scan().where("stream = 'S-1' and streamSeq <= 50"), "seed", at(0))
    consumer.advance_floors()
    assert keys(consumer.pull_batch("p1", at(1), fetch=10)) == [("S-0", n) for n in range(1, 11)]
    assert keys(consumer.pull_batch("p2", at(2), fetch=10)) == [("S-1", n) for n in range(51, 61)]
    assert keys(consumer.pull_batch("p3", at(3), fetch=10)) == []
    consumer.commit_batch("p1", at(4))
    assert keys(consumer.pull_batch("p4", at(5), fetch=4, listeners=2)) == [("S-0", n) for n in range(11, 19)]


@pytest.mark.parametrize("seed", range(3))
def test_capped_pulls_against_a_plain_version(spark, log, seed):
    """Pulls, commits and ends of waits in random order: what is given equals a list-based consumer."""
    r = random.Random(seed)
    fill(log, 60, streams=3)
    consumer = D.Delivery(log, "c")
    cap, fetch, wait = r.randrange(2, 9), r.randrange(2, 9), 10
    consumer.store.open(create=True, ack_wait=wait, max_ack_pending=cap)
    acked, given, pulls = set(), {}, {}
    everything = [(f"S-{s}", n) for n in range(1, 21) for s in range(3)]
    for step in range(6):
        now = step * 4
        held = {k for k, t in given.items() if t + wait > now and k not in acked}
        room = {f"S-{s}": cap - sum(k[0] == f"S-{s}" for k in held) for s in range(3)}
        want = []
        for key in everything:
            if key not in acked and key not in held and room[key[0]] > 0 and len(want) < fetch:
                want.append(key)
                room[key[0]] -= 1
        assert keys(consumer.pull_batch(f"p{step}", at(now), fetch=fetch)) == sorted(want)
        given |= dict.fromkeys(want, now)
        pulls[step] = want
        if r.random() < 0.6:
            chosen = r.choice(list(pulls))
            consumer.commit_batch(f"p{chosen}", at(now + 1))
            acked |= set(pulls.pop(chosen))


def test_commits_look_at_open_acks_only(spark, log):
    """Whatever was acknowledged before, a commit reads the batches that reach beyond the floors."""
    fill(log, 60)
    consumer = D.Delivery(log, "c")
    for k in range(5):
        consumer.pull_batch(f"p{k}", at(k), fetch=10)
    for k in (0, 1, 3):
        consumer.commit_batch(f"p{k}", at(10))
    assert consumer.floors() == {"S-0": 20} and consumer.store.open_acks() == ["p3"]
    assert consumer.open_acks().count() == 10 and consumer.acks().count() == 30
    consumer.commit_batch("p2", at(11))
    assert consumer.floors() == {"S-0": 40} and consumer.store.open_acks() == []
    assert keys(consumer.pull_batch("q", at(12), fetch=20)) == [("S-0", n) for n in range(51, 61)]
    consumer.commit_batch("p4", at(13))
    consumer.commit_batch("q", at(13))
    assert consumer.floors() == {"S-0": 60} and consumer.acks().count() == 60


def test_acks_written_without_a_list_are_all_open(spark, log):
    fill(log, 20)
    consumer = D.Delivery(log, "c")
    log.scan().where("streamSeq <= 5").select("stream", "streamSeq", at(0).alias("acked_at")).write.parquet(
        f"{log.path}/acks/consumer=c/batch=old"
    )
    assert consumer.store.open_acks() is None and consumer.open_acks().count() == 5
    consumer.write_acks(log.scan().where("streamSeq in (6, 9)"), "new", at(1))
    assert consumer.advance_floors() == {"S-0": 6} and consumer.store.open_acks() == ["new"]
