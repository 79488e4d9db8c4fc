"""Opening the streaming source with its options applied."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from msgflow.functions.subjects import subject_filter
from msgflow.operators.codec import decode_payload
from msgflow.operators.envelope import deliver, to_text3, to_text5
from msgflow.options import SourceOptions
from msgflow.session import ship_package
from msgflow.sources.consumers import ConsumerStore
from msgflow.sources.index import LogIndex
from msgflow.sources.log import MessageLog
from msgflow.sources.msglog import MessageLogSource, MessageRangeSource
from msgflow.streaming.idle import SourceWatch


_registered: set[str] = set()


def register(spark: SparkSession) -> None:
    """Make ``format("msglog")`` known, once per application."""
    ship_package()
    if spark.sparkContext.applicationId not in _registered:
        spark.dataSource.register(MessageLogSource)
        spark.dataSource.register(MessageRangeSource)
        spark.streams.addListener(SourceWatch(spark))
        _registered.add(spark.sparkContext.applicationId)


def read_stream(spark: SparkSession, received_at: Column | None = None, **options: object) -> DataFrame:
    """A stream over a message log in the wanted envelope.

    ``received_at`` replaces the wall clock as receive time of text5 envelopes. The option
    ``columns`` names the full-envelope columns to read; Spark cannot prune a Python source by itself.
    """
    parsed = SourceOptions.from_options(options)
    if parsed.columns and parsed.envelope != "full":
        raise ValueError("Option 'columns' is for full envelopes")
    register(spark)
    plain = {k: str(v) for k, v in options.items() if k.lower() != "envelope" and v is not None}
    messages = spark.readStream.format("msglog").options(**plain).load()
    if parsed.envelope == "text5":
        return to_text5(messages, F.current_timestamp() if received_at is None else received_at, parsed.datetime_format)
    if parsed.envelope == "text3":
        return to_text3(messages)
    return messages


@dataclass
class RangeBatch:
    """One micro-batch of a log: the range of each stream. Its messages are read by Spark's own Parquet scan, as often as
    they are needed."""

    log: MessageLog
    options: SourceOptions
    ranges: dict[str, tuple[int, int]]
    ends: dict[str, int] = field(init=False)

    def __post_init__(self) -> None:
        self.ends = {s: upto for s, (_, upto) in self.ranges.items()}

    def stored(self) -> DataFrame:
        """The batch's messages as the log stores them, without those that the subjects leave out."""
        subjects = self.options.subjects
        if self.options.consumer and not self.options.create_consumer:
            subjects = ConsumerStore(self.log.path, self.options.consumer).settings().get("subjects", [])
        messages = self.log.scan_range({s: after for s, (after, _) in self.ranges.items()}, self.ends)
        return messages.where(subject_filter(subjects))

    def messages(self) -> DataFrame:
        """The batch's messages in the full envelope, payloads decoded."""
        read = self.options
        rows = deliver(self.stored(), self.ends, read.consumer or "", read.domain, read.account)
        return decode_payload(rows, read.codec, strict=read.strict)


def each_batch(spark: SparkSession, source: Mapping[str, object], handle: Callable[[RangeBatch, int], None]) -> DataStreamWriter:
    """A stream over a log whose batches ``handle(batch, batch_id)`` works on; set checkpoint and trigger on the result.

    The source carries ranges only, one row per stream, so no message passes a Python worker or a cache. ``handle`` gets
    the same batch again after a failure. Batches without messages are left out.
    """
    options = SourceOptions.from_options(source)
    if options.envelope != "full" or options.columns:
        raise ValueError("Options 'envelope' and 'columns' are for read_stream")
    register(spark)
    index = LogIndex(options.path.rstrip("/"))  # lives as long as the query: each batch reads new manifests only

    def run(rows: DataFrame, batch_id: int) -> None:
        ranges = {r["stream"]: (r["after"], r["upto"]) for r in rows.collect()}  # one row per stream
        if ranges:
            handle(RangeBatch(MessageLog(rows.sparkSession, options.path, index), options, ranges), batch_id)

    plain = {k: str(v) for k, v in source.items() if v is not None}
    return spark.readStream.format("msglog_ranges").options(**plain).load().writeStream.foreachBatch(run)
