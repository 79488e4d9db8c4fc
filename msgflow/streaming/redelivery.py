"""Redelivery in a stream: a stateful operator with timers that waits for the acks of what was delivered.

State is kept per consumer, stream and block of 4,096 sequence numbers, so a stream with most messages is spread over many
keys and one call handles many messages as arrays. A block holds the deliveries that still wait, the acks that came
since the watermark, and one bit for every number acknowledged before it. The bits stay, so an ack ends a matter
however old it is; a block without a waiting delivery costs its 512 bytes and no timer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from msgflow.session import ship_package

BLOCK_BITS = 12
BLOCK = 1 << BLOCK_BITS
_NEVER = np.iinfo(np.int64).max
_ALWAYS = np.iinfo(np.int64).min

WAITING = np.dtype([("seq", "<i8"), ("at", "<i8"), ("attempt", "<i8")])
ACKED = np.dtype([("seq", "<i8"), ("at", "<i8")])

_KEY = ["consumer", "stream", "block"]
_STATE = "acked binary, recent binary, waiting binary, timer long"
_OUT = "consumer string, stream string, streamSeq long, attempt long, delivered_at timestamp"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def settle(
    acked: np.ndarray, recent: np.ndarray, waiting: np.ndarray, watermark: int, wait: int, resend: bool, most: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One step of a block: (acked, recent, waiting) afterwards, and the rows to give out.

    Times are microseconds. Everything up to the watermark is known. A delivery is settled by an ack up to the end of its
    wait. If its wait ends at or before the watermark without one, it is given out; with ``resend`` it is given out as
    the next attempt, delivered at the end of the wait, which then waits itself, up to ``most`` attempts.
    """
    ack_at = np.where(np.unpackbits(acked, bitorder="little").astype(bool), _ALWAYS, _NEVER)
    np.minimum.at(ack_at, recent["seq"] & (BLOCK - 1), recent["at"])
    given = []
    while len(waiting):
        ends = waiting["at"] + wait
        waiting = waiting[ack_at[waiting["seq"] & (BLOCK - 1)] > ends]
        late = waiting["at"] + wait <= watermark
        due, waiting = waiting[late].copy(), waiting[~late]
        if not len(due):
            break
        if resend:
            due["at"] += wait
            due["attempt"] += 1
            due = due[due["attempt"] <= most]
            waiting = np.concatenate([waiting, due])
        given.append(due)
    # What is delivered from here on is later than these acks, so their time no longer matters.
    old = recent["at"] <= watermark
    bits = np.unpackbits(acked, bitorder="little")
    bits[recent["seq"][old] & (BLOCK - 1)] = 1
    out = np.concatenate(given) if given else np.zeros(0, WAITING)
    return np.packbits(bits, bitorder="little"), recent[~old], waiting, out


class AckWaits(StatefulProcessor):
    """Keys are (consumer, stream, block); rows have streamSeq, at (microseconds), attempt and acked."""

    def __init__(self, wait: int, resend: bool, most: int):
        self.wait, self.resend, self.most = wait, resend, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("block", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        sent, done = [], []
        for part in rows:
            acks = part["acked"].to_numpy(bool)
            columns = [part[c].to_numpy(np.int64) for c in ("streamSeq", "at", "attempt")]
            sent.append(np.rec.fromarrays([c[~acks] for c in columns], dtype=WAITING))
            done.append(np.rec.fromarrays([c[acks] for c in columns[:2]], dtype=ACKED))
        yield from self._step(key, np.concatenate(sent), np.concatenate(done), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._step(key, np.zeros(0, WAITING), np.zeros(0, ACKED), timerValues)

    def _step(self, key, sent: np.ndarray, done: np.ndarray, timer_values) -> Iterator[pd.DataFrame]:
        held = self.state.get() if self.state.exists() else None
        acked, recent, waiting = (
            np.frombuffer(held[k] if held else b"\0" * n, kind)
            for k, (kind, n) in enumerate([(np.uint8, BLOCK // 8), (ACKED, 0), (WAITING, 0)])
        )
        watermark = timer_values.getCurrentWatermarkInMs()
        acked, recent, waiting, out = settle(
            acked,
            np.concatenate([recent, done]),
            np.concatenate([waiting, sent]),
            watermark * 1000,
            self.wait,
            self.resend,
            self.most,
        )
        timer = self._set_timer(held[3] if held else 0, waiting, watermark)
        self.state.update((acked.tobytes(), recent.tobytes(), waiting.tobytes(), timer))
        if len(out):
            consumer, stream, _ = key
            yield pd.DataFrame(
                {
                    "consumer": consumer,
                    "stream": stream,
                    "streamSeq": out["seq"],
                    "attempt": out["attempt"],
                    "delivered_at": pd.to_datetime(out["at"], unit="us", utc=True),
                }
            )

    def _set_timer(self, timer: int, waiting: np.ndarray, watermark: int) -> int:
        """One timer at the first end of a wait; 0 for none."""
        wanted = max(-(-int(waiting["at"].min() + self.wait) // 1000), watermark + 1) if len(waiting) else 0
        if wanted != timer:
            if timer > watermark:
                self.handle.deleteTimer(timer)
            if wanted:
                self.handle.registerTimer(wanted)
        return wanted


def use_timers(spark: SparkSession) -> None:
    """Timers need the RocksDB state store; a provider that the user has set is kept."""
    if _PROVIDER not in spark.conf.getAll:
        spark.conf.set(_PROVIDER, _ROCKSDB)


def _waits(deliveries: DataFrame, acks: DataFrame, delay: str, processor: AckWaits) -> DataFrame:
    ship_package()
    use_timers(deliveries.sparkSession)
    keys = ["consumer", "stream", "streamSeq"]
    attempt = F.col("attempt") if "attempt" in deliveries.columns else F.lit(1)
    sent = deliveries.withWatermark("delivered_at", delay).select(
        *keys, F.col("delivered_at").alias("time"), attempt.cast("long").alias("attempt"), F.lit(False).alias("acked")
    )
    done = acks.withWatermark("acked_at", delay).select(
        *keys, F.col("acked_at").alias("time"), F.lit(0).cast("long").alias("attempt"), F.lit(True).alias("acked")
    )
    rows = sent.union(done).withColumn("at", F.unix_micros("time"))
    rows = rows.withColumn("block", F.shiftright("streamSeq", BLOCK_BITS))
    return rows.groupBy(*_KEY).transformWithStateInPandas(processor, _OUT, "append", "EventTime")


def redeliveries(deliveries: DataFrame, acks: DataFrame, ack_wait: int, delay: str = "1 minute") -> DataFrame:
    """Deliveries, any attempt, whose message had no ack by the end of their wait; given out when the watermark shows that
    none can come. An ack counts whenever it came, also long before the delivery.

    ``deliveries`` is a stream with consumer, stream, streamSeq, delivered_at, attempt (default 1), ``acks`` one with
    consumer, stream, streamSeq, acked_at. The watermark is the earlier of both. The session's state store becomes
    RocksDB, which timers need, unless one is set.
    """
    return _waits(deliveries, acks, delay, AckWaits(int(ack_wait * 1_000_000), False, 0))


def redeliver(
    deliveries: DataFrame, acks: DataFrame, ack_wait: int, max_deliver: int | None = None, delay: str = "1 minute"
) -> DataFrame:
    """The repeated deliveries of messages that are not acknowledged: one after each ack wait, with the number of the attempt
    and the time it is due, until an ack came or ``max_deliver`` attempts are made.

    ``deliveries`` holds the first deliveries (further ones count their own waits). Streams and state as in
    ``redeliveries``; the state grows with the open messages and one bit for each acknowledged one.
    """
    most = np.iinfo(np.int64).max if max_deliver is None else max_deliver
    return _waits(deliveries, acks, delay, AckWaits(int(ack_wait * 1_000_000), True, int(most)))
