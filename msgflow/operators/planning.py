"""Offsets, ranges and batch plans over a message log.

Sequence numbers are dense per stream, so slices, shares and next-k reads are arithmetic on
``streamSeq`` that Parquet statistics can prune; no window runs over a stream.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgflow.session import join_small

Offsets = dict[str, int]

# Up to this many streams, per-stream bounds are written into the plan as predicates.
FEW_STREAMS = 200


def latest_offsets(messages: DataFrame) -> DataFrame:
    """Last sequence number per stream, counted from the table itself."""
    return messages.groupBy("stream").agg(F.max("streamSeq").alias("last_seq"))


def check_offsets(offsets: Offsets) -> Offsets:
    if not isinstance(offsets, dict):
        raise ValueError(f"Not a stream offset: {offsets!r}")
    for stream, seq in offsets.items():
        if isinstance(seq, bool) or not isinstance(seq, int) or seq < 0:
            raise ValueError(f"Bad offset {seq!r} for stream '{stream}'")
    return offsets


def clamp_end(end: Offsets, heads: Offsets) -> Offsets:
    """Ends that do not lie beyond the streams' last messages."""
    return {s: min(e, heads.get(s, 0)) for s, e in check_offsets(end).items()}


def start_offsets(
    streams: list[str], stored: Offsets | None, reset_on_restart: bool = False, first_batch: bool = True
) -> Offsets:
    """Where a batch starts: the stored position, or the beginning on a first run or a wanted reset."""
    if stored is None or (reset_on_restart and first_batch):
        return dict.fromkeys(streams, 0)
    return {s: check_offsets(stored).get(s, 0) for s in streams}


def with_offset(df: DataFrame, offsets: Offsets, out: str) -> DataFrame:
    """Add the offset of the row's stream, 0 when it has none.

    A few streams become a plain expression without a join, many become a checked broadcast.
    """
    known = {s: o for s, o in check_offsets(offsets).items() if o}
    if len(known) > FEW_STREAMS:
        frame = df.sparkSession.createDataFrame(sorted(known.items()), f"stream string, `{out}` bigint")
        return join_small(df, frame, ["stream"], len(known), "left").fillna(0, [out])
    found = F.lit(None).cast("long")
    for stream, offset in sorted(known.items()):
        found = F.when(F.col("stream") == stream, F.lit(offset).cast("long")).otherwise(found)
    return df.withColumn(out, F.coalesce(found, F.lit(0).cast("long")))


def beyond(df: DataFrame, floors: Offsets) -> DataFrame:
    """Rows after their stream's floor; streams without a floor are kept whole."""
    if not floors:
        return df
    if len(floors) > FEW_STREAMS:
        return with_offset(df, floors, "_floor").where(F.col("streamSeq") > F.col("_floor")).drop("_floor")
    listed = [(F.col("stream") == s) & (F.col("streamSeq") > f) for s, f in sorted(check_offsets(floors).items())]
    return df.where(reduce(lambda a, b: a | b, listed, ~F.col("stream").isin(sorted(floors))))


def range_scan(df: DataFrame, start: Offsets, end: Offsets) -> DataFrame:
    """Rows in ``(start, end]`` of each stream in ``end``; a missing start is the beginning.

    For few streams the bounds are a predicate that prunes directories and row groups.
    """
    check_offsets(start)
    ranges = {s: (start.get(s, 0), e) for s, e in check_offsets(end).items() if e > start.get(s, 0)}
    if len(ranges) > FEW_STREAMS:
        rows = [(s, lo, hi) for s, (lo, hi) in sorted(ranges.items())]
        frame = df.sparkSession.createDataFrame(rows, "stream string, _lo bigint, _hi bigint")
        hit = (F.col("streamSeq") > F.col("_lo")) & (F.col("streamSeq") <= F.col("_hi"))
        # The join's bounds are not known to the scan; the outermost ones are, and prune row groups there.
        df = df.where(F.col("streamSeq").between(min(r[1] for r in rows) + 1, max(r[2] for r in rows)))
        return join_small(df, frame, ["stream"], len(rows)).where(hit).drop("_lo", "_hi")
    seq = F.col("streamSeq")
    tests = [(F.col("stream") == s) & (seq > lo) & (seq <= hi) for s, (lo, hi) in sorted(ranges.items())]
    return df.where(reduce(lambda a, b: a | b, tests) if tests else F.lit(False))


def select_streams(messages: DataFrame, streams: list[str] | None = None, prefix: str | None = None) -> DataFrame:
    """Messages of streams chosen by name or by the prefix of numbered partition streams."""
    if streams is not None:
        messages = messages.where(F.col("stream").isin(streams))
    if prefix is not None:
        numbered = F.substring(F.col("stream"), len(prefix) + 2, 1 << 30).rlike(r"^\d+$")
        messages = messages.where(F.col("stream").startswith(prefix + "-") & numbered)
    return messages


def batch_slices(messages: DataFrame, start: Offsets, batch_size: int) -> DataFrame:
    """Add the number of the read slice, 0, 1, 2 …, each of at most ``batch_size`` messages."""
    position = F.col("streamSeq") - F.col("_start") - 1
    sliced = with_offset(messages, start, "_start").withColumn("slice", F.call_function("div", position, F.lit(batch_size)))
    return sliced.drop("_start")


def slice_counts(start: Offsets, end: Offsets, batch_size: int) -> Offsets:
    """Number of read slices per stream: pending over batch size, rounded up."""
    return {s: -(-max(0, e - start.get(s, 0)) // batch_size) for s, e in end.items()}


def listener_share(messages: DataFrame, listeners: int) -> DataFrame:
    """Add the listener that takes each message; shares do not overlap and leave nothing out."""
    return messages.withColumn("listener", F.pmod(F.col("streamSeq"), F.lit(listeners)))


def next_fetch(messages: DataFrame, floors: Offsets, size: int, max_request_batch: int | None = None) -> DataFrame:
    """The next messages of a consumer after its position, at most ``size`` per stream."""
    size = size if max_request_batch is None else min(size, max_request_batch)
    # The plain bound is the one the Parquet scan can use.
    near = messages.where(F.col("streamSeq") <= max(floors.values(), default=0) + size)
    after = F.col("streamSeq") - F.col("_floor")
    return with_offset(near, floors, "_floor").where(after.between(1, size)).drop("_floor")
