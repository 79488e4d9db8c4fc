"""Delivery accounting over the deliveries and acks tables: pending, floors, lag, redelivery, commits.

Both tables are narrow (consumer, stream, streamSeq, time). Duplicate rows of one message are folded
before any join, so a message delivered or acknowledged very often stays one row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from msgflow import schemas
from msgflow.functions.subjects import subject_filter
from msgflow.operators.planning import beyond, range_scan, with_offset
from msgflow.operators.ranking import first_in_stream, previous_in_stream
from msgflow.session import join_small
from msgflow.sources import files
from msgflow.sources.consumers import ConsumerStore
from msgflow.sources.log import MessageLog

KEY = ["stream", "streamSeq"]

# Acks are kept as bit masks: one 64-bit word per 64 numbers, and words counted per span of 32,768.
WORD_BITS = 6
SPAN_BITS = 15
SPAN = 1 << SPAN_BITS


def _ack_words(acks: DataFrame) -> DataFrame:
    """Acknowledged numbers as masks per stream and word; repeats vanish before the shuffle."""
    seq = F.col("streamSeq")
    bit = F.expr(f"shiftleft(1L, cast(streamSeq & {(1 << WORD_BITS) - 1} as int))")
    return acks.groupBy("stream", F.shiftright(seq, WORD_BITS).alias("_word")).agg(F.bit_or(bit).alias("_mask"))


def _without_acked(messages: DataFrame, acks: DataFrame) -> DataFrame:
    """Messages whose bit is not set: an anti-join with a side 64 times shorter than the acks."""
    word = F.shiftright("streamSeq", WORD_BITS)
    bit = F.expr(f"cast(streamSeq & {(1 << WORD_BITS) - 1} as int)")
    marked = messages.withColumn("_word", word).join(_ack_words(acks), ["stream", "_word"], "left")
    is_open = F.col("_mask").isNull() | (F.getbit("_mask", bit) == 0)
    return marked.where(is_open).select(*messages.columns)


def pending_messages(messages: DataFrame, acks: DataFrame, floors: dict[str, int] | None = None) -> DataFrame:
    """Messages not acknowledged yet. Known floors spare the scan of what lies below them."""
    floors = floors or {}
    return _without_acked(beyond(messages, floors), beyond(acks, floors))


def pending_counts(heads: DataFrame, acks: DataFrame, floors: dict[str, int] | None = None) -> DataFrame:
    """Unacknowledged messages per stream from the acks alone: the log is not read.

    ``heads`` has stream and head.
    """
    floors = floors or {}
    acked = _acked_per_span(beyond(acks, floors)).groupBy("stream").agg(F.sum("_count").alias("_acked"))
    joined = with_offset(heads.join(acked, "stream", "left"), floors, "_floor")
    return joined.select(
        "stream", (F.col("head") - F.col("_floor") - F.coalesce(F.col("_acked"), F.lit(0))).alias("pending")
    )


def _acked_per_span(acks: DataFrame) -> DataFrame:
    """Number of distinct acknowledged messages per stream and span."""
    span = F.shiftright("_word", SPAN_BITS - WORD_BITS).alias("_span")
    return _ack_words(acks).groupBy("stream", span).agg(F.sum(F.bit_count("_mask")).alias("_count"))


def ack_floors(heads: DataFrame, acks: DataFrame, floors: dict[str, int] | None = None) -> DataFrame:
    """Per stream the highest number up to which every message is acknowledged, and the lag behind the end.

    First the first span that is not complete is found from span counts. Only the acks of that one
    span per stream are then searched for the first gap; no stream is sorted or gathered as a whole.
    Floors known from before spare the reading of what lies below them.
    """
    floors = floors or {}
    newer = beyond(acks, floors)
    # Numbers from 0 up to the floor count as acknowledged; number 0 itself does not exist. The search
    # starts in the span of the number after the floor.
    floor_span = F.shiftright(F.col("_floor") + 1, SPAN_BITS)
    counted = with_offset(_acked_per_span(newer), floors, "_floor")
    below = F.when(F.col("_span") == floor_span, (F.col("_floor") + 1) % SPAN).otherwise(F.lit(0))
    complete = counted.where(F.col("_count") + below == SPAN).select("stream", "_span")
    gaps = (
        complete.select("stream", (F.col("_span") + 1).alias("_span"))
        .union(with_offset(heads, floors, "_floor").select("stream", floor_span.alias("_span")))
        .join(complete, ["stream", "_span"], "left_anti")
        .groupBy("stream")
        .agg(F.min("_span").alias("_gap"))
        .collect()  # one row per stream
    )
    before = {r["stream"]: max(r["_gap"] * SPAN - 1, floors.get(r["stream"], 0)) for r in gaps}
    ends = {r["stream"]: (r["_gap"] + 1) * SPAN - 1 for r in gaps}
    near = range_scan(newer, before, ends).select(*KEY).distinct()
    starts = heads.sparkSession.createDataFrame(sorted(before.items()), "stream string, streamSeq bigint")
    found = (
        near.union(starts)
        .join(near.select("stream", (F.col("streamSeq") - 1).alias("streamSeq")), KEY, "left_anti")
        .groupBy("stream")
        .agg(F.min("streamSeq").alias("ack_floor"))
    )
    lag = (F.col("head") - F.col("ack_floor")).alias("lag")
    return heads.join(found, "stream").select("stream", "ack_floor", "head", lag)


def delivery_counts(deliveries: DataFrame) -> DataFrame:
    return deliveries.groupBy("consumer", *KEY).agg(F.count(F.lit(1)).alias("delivered"))


def repeated_messages(deliveries: DataFrame) -> DataFrame:
    """Messages seen more than once: the sign of an ack wait that is too short."""
    return deliveries.groupBy(*KEY).agg(F.count(F.lit(1)).alias("seen")).where(F.col("seen") > 1)


def drop_repeats(deliveries: DataFrame) -> DataFrame:
    return deliveries.dropDuplicates(KEY)


def redelivery_due(
    deliveries: DataFrame, acks: DataFrame, ack_wait: int, now: Column, ack_none: bool = False
) -> DataFrame:
    """Messages to deliver again at ``now``: the wait of the last delivery is over and no ack came up to ``now``.

    Deliveries and acks after ``now`` do not count. An ack ends the matter whenever it came, also before a repeated delivery.
    """
    wait = F.make_dt_interval(secs=F.lit(ack_wait))
    last = deliveries.where(F.col("delivered_at") <= now).groupBy("consumer", *KEY).agg(
        F.max("delivered_at").alias("delivered_at"), F.count(F.lit(1)).alias("attempts")
    )
    if ack_none:
        return last.where(F.lit(False))
    acked = acks.where(F.col("acked_at") <= now).select("consumer", *KEY).distinct()
    late = last.where(F.col("delivered_at") + wait <= now)
    return late.join(acked, ["consumer", *KEY], "left_anti").select("consumer", *KEY, "delivered_at", "attempts")


def first_unacked(
    messages: DataFrame,
    excluded: DataFrame,
    floors: dict[str, int],
    k: int,
    listeners: int | None = None,
    subjects: tuple[str, ...] = (),
) -> DataFrame:
    """The first k messages not in ``excluded``, per stream, or per listener over all streams."""
    shut = beyond(excluded, floors)
    open_messages = beyond(messages, floors).where(subject_filter(subjects))
    if not subjects:
        reach, rest = search_ends(shut, floors, k, listeners or 1)
        near = open_messages.where(F.col("streamSeq") <= max(reach.values(), default=0) + rest)
        extra = {s: r - rest for s, r in reach.items()}
        open_messages = with_offset(near, extra, "_extra").where(F.col("streamSeq") <= F.col("_extra") + rest).drop("_extra")
    return _pick(_without_acked(open_messages, shut), k, listeners)


def search_ends(shut: DataFrame, floors: dict[str, int], k: int, shares: int) -> tuple[dict[str, int], int]:
    """How far each stream must be read to find k open messages for every share of it.

    Numbers are dense, so among the next shares * (k + shut ones beyond the floor) numbers every
    share has at least k open ones. The second value is the end for streams not named in the first.
    A subject filter voids this bound; then the whole rest of the log has to be looked at.
    """
    counts = _acked_per_span(shut).groupBy("stream").agg(F.sum("_count").alias("n")).collect()  # one row per stream
    taken = {r["stream"]: r["n"] for r in counts}
    return {s: floors.get(s, 0) + shares * (k + taken.get(s, 0)) for s in {*floors, *taken}}, shares * k


def _within_cap(left: DataFrame, in_flight: DataFrame, cap: int, most: int) -> DataFrame:
    """The open messages a pull may choose from: of each stream the first ones, as many as its cap leaves room for.

    The room is counted before anything is chosen, so what a full stream cannot take is dealt to the others. At most
    ``most`` messages of a stream can be chosen, so no more of them are ranked.
    """
    near = first_in_stream(left, ["stream"], min(cap, most))
    taken = in_flight.groupBy("stream").agg(F.count("*").alias("_held"))
    place = F.row_number().over(Window.partitionBy("stream").orderBy("streamSeq"))
    joined = near.withColumn("_place", place).join(taken, "stream", "left")
    return joined.where(F.col("_place") + F.coalesce("_held", F.lit(0)) <= cap).select(*left.columns)


def _pick(left: DataFrame, k: int, listeners: int | None) -> DataFrame:
    if listeners is None:
        return first_in_stream(left, ["stream"], k)
    shared = left.withColumn("listener", F.pmod(F.col("streamSeq"), F.lit(listeners)))
    # First k of each stream: what then meets per listener is at most k rows a stream, however large the log.
    near = first_in_stream(shared, ["listener", "stream"], k)
    return first_in_stream(near, ["listener"], k, ties=["stream"])


def inflight_capped(messages: DataFrame, acks: DataFrame, floors: dict[str, int], max_ack_pending: int) -> DataFrame:
    """Messages a consumer may hold unacknowledged at once: the first ``max_ack_pending`` per stream."""
    return first_unacked(messages, acks, floors, max_ack_pending)


def idle_gaps(messages: DataFrame, minutes: float) -> DataFrame:
    """Messages that came more than ``minutes`` after the one before them in their stream."""
    with_previous = previous_in_stream(messages, ["stream"], F.col("timestamp"), "previous_at")
    gap = F.unix_micros("timestamp") - F.unix_micros("previous_at")
    return with_previous.withColumn("gap_us", gap).where(gap > int(minutes * 60_000_000))


@dataclass
class Delivery:
    """One consumer's pulls and commits on a log; batches are kept as tables, not in memory."""

    log: MessageLog
    consumer: str
    ack_none: bool = False

    def __post_init__(self) -> None:
        self.store = ConsumerStore(self.log.path, self.consumer)

    @property
    def spark(self) -> SparkSession:
        return self.log.spark

    def deliveries(self) -> DataFrame:
        return self._table("deliveries", schemas.DELIVERIES)

    def acks(self) -> DataFrame:
        return self._table("acks", schemas.ACKS)

    def open_acks(self) -> DataFrame:
        """The acks of batches that reach beyond the floors: all that pulls and commits have to look at. How many there are
        depends on what is open, not on how long the consumer has run."""
        known = self.store.open_acks()
        if known is None:
            return self.acks()
        root = f"{self.log.path}/acks"
        folders = [f for f in (self._folder("acks", b) for b in known) if files.exists(f"{f}/_SUCCESS")]
        if not folders:
            return self.spark.createDataFrame([], schemas.ACKS)
        return self.spark.read.schema(schemas.ACKS).option("basePath", root).parquet(*folders)

    def pull_batch(
        self,
        batch: str,
        now: Column,
        fetch: int,
        listeners: int = 1,
        ack_wait: int | None = None,
        subjects: tuple[str, ...] | None = None,
    ) -> DataFrame:
        """Deliver the next open messages, at most ``fetch`` per listener, as a finite batch.

        Acknowledged messages and those still within their ack wait are left out. What is not given
        comes from the consumer's settings; its cap on unacknowledged messages holds per stream over all pulls, and
        a stream at its cap leaves the pull to the others.
        Asking for more than its ``max_request_batch`` is an error.
        """
        folder = self._folder("deliveries", batch)
        if files.exists(f"{folder}/_SUCCESS"):
            return self.batch_messages(batch)
        settings = self.store.settings()
        most = int(settings.get("max_request_batch", fetch))
        if fetch > most:
            raise ValueError(f"fetch={fetch} is more than the consumer's max_request_batch={most}")
        ack_wait = int(settings.get("ack_wait", 90)) if ack_wait is None else ack_wait
        subjects = tuple(settings.get("subjects", ())) if subjects is None else subjects
        floors = self.floors()
        acked = beyond(self.open_acks(), floors).select(*KEY)
        held = beyond(self.deliveries(), floors)
        if not self.ack_none:
            held = held.where(F.col("delivered_at") + F.make_dt_interval(secs=F.lit(ack_wait)) > now)
        held = held.select(*KEY)
        shut = acked.union(held)
        if subjects:
            open_messages = beyond(self.log.scan(), floors).where(subject_filter(subjects))
        else:
            reach, rest = search_ends(shut, floors, fetch, listeners)
            open_messages = self.log.scan_range(floors, {s: reach.get(s, rest) for s in self.log.heads()})
        left = _without_acked(open_messages.select(*KEY), shut)
        cap = int(settings.get("max_ack_pending", 0))
        if cap > 0 and not self.ack_none:
            left = _within_cap(left, _without_acked(held.distinct(), acked), cap, fetch * listeners)
        picked = _pick(left, fetch, listeners)
        earlier = beyond(self.deliveries(), floors).groupBy(*KEY).agg(F.count(F.lit(1)).alias("_n"))
        rows = picked.join(earlier, KEY, "left").select(
            *KEY, now.alias("delivered_at"), (F.coalesce("_n", F.lit(0)) + 1).alias("attempt"), "listener"
        )
        rows.write.mode("overwrite").parquet(folder)
        return self.batch_messages(batch)

    def batch_messages(self, batch: str) -> DataFrame:
        """The messages of a pulled batch; empty for an unknown one."""
        folder = self._folder("deliveries", batch)
        if not files.exists(folder):
            empty = self.log.scan_range({}, {})
            return empty.withColumns({"attempt": F.lit(1).cast("long"), "listener": F.lit(0).cast("long")})
        taken = self.spark.read.schema("stream string, streamSeq bigint, attempt bigint, listener bigint").parquet(folder)
        # The batch spans a short piece of each stream; its ends let the log scan skip the rest.
        ends = taken.groupBy("stream").agg(F.min("streamSeq").alias("lo"), F.max("streamSeq").alias("hi")).collect()
        part = self.log.scan_range({r["stream"]: r["lo"] - 1 for r in ends}, {r["stream"]: r["hi"] for r in ends})
        return join_small(part, taken, KEY, taken.count())

    def commit_batch(self, batch: str, now: Column) -> int:
        """Acknowledge every message of a pulled batch and move the position; the number of messages, 0 for an unknown batch.

        The first commit counts: another one changes neither the acks nor their time.
        """
        folder = self._folder("deliveries", batch)
        if self.ack_none or not files.exists(folder):
            return 0
        taken = self.spark.read.schema("stream string, streamSeq bigint").parquet(folder)
        if not files.exists(f"{self._folder('acks', batch)}/_SUCCESS"):
            self.write_acks(taken, batch, now)
            self.advance_floors()
        return taken.count()

    def write_acks(self, messages: DataFrame, batch: str, now: Column, closed: bool = False) -> None:
        """Acknowledge messages under a batch id; doing it again replaces the same rows. ``closed`` says that the floors
        move beyond all of them."""
        if not closed:
            known = self.store.open_acks()
            if known is None:
                known = [n.removeprefix("batch=") for n in files.list_names(self._folder("acks", batch).rsplit("/", 1)[0])]
            self.store.keep_open_acks([*known, batch])
        rows = messages.select(*KEY, now.alias("acked_at"))
        rows.write.mode("overwrite").parquet(self._folder("acks", batch))

    def advance_floors(self) -> dict[str, int]:
        """Recompute the positions from the open acks and store them; batches below them are not looked at again.

        With a subject filter, messages the consumer never gets do not hold its position back.
        """
        subjects = tuple(self.store.settings().get("subjects", []))
        heads, acks = self.log.heads_frame(), self.open_acks()
        if not subjects:
            found = ack_floors(heads, acks, self.floors()).select("stream", "ack_floor")
        else:
            wanted = self.log.scan().where(subject_filter(subjects)).select(*KEY)
            still_open = pending_messages(wanted, acks, self.floors())
            first = still_open.groupBy("stream").agg((F.min("streamSeq") - 1).alias("_floor"))
            found = heads.join(first, "stream", "left").select("stream", F.coalesce("_floor", "head").alias("ack_floor"))
        floors = self.store.advance({r["stream"]: r["ack_floor"] for r in found.collect()})  # one row per stream
        # One name per batch that still reaches beyond the floors.
        left = beyond(acks, {s: int(f) for s, f in floors.items()}).select("batch").distinct().collect()
        self.store.keep_open_acks([r["batch"] for r in left])
        return floors

    def floors(self) -> dict[str, int]:
        return {s: int(f) for s, f in self.store.floors().items()}

    def _folder(self, table: str, batch: str) -> str:
        return f"{self.log.path}/{table}/consumer={self.consumer}/batch={batch}"

    def _table(self, name: str, schema) -> DataFrame:
        root = f"{self.log.path}/{name}"
        own = f"{root}/consumer={self.consumer}"
        if not files.exists(own):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", root).parquet(own)
