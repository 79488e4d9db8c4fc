"""Publishing to a message log, from batch frames and from streams."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from msgflow.operators.envelope import conform_to_sink, publish_rows, text_rows
from msgflow.operators.routing import guard_subjects
from msgflow.options import SinkOptions
from msgflow.sources.index import LogIndex
from msgflow.sources.log import MessageLog


def publish(
    log: MessageLog,
    df: DataFrame,
    stream: str | Column,
    batch: str,
    subjects: tuple[str, ...] = (),
    order_by: list[str] | None = None,
    timestamp: Column | None = None,
) -> int:
    """Append sink rows (subject, data, headers); returns the number of new messages.

    ``stream`` names the target, or gives it per row. ``subjects`` is the stream's subject list; a
    row outside it fails the whole batch. ``order_by`` fixes the numbering order within a stream,
    ``timestamp`` the ingest time (default: now).
    """
    order = {f"_order{i}": F.col(c) for i, c in enumerate(order_by or [])}
    extra = dict(order)
    extra["stream"] = F.lit(stream) if isinstance(stream, str) else stream
    extra["timestamp"] = F.current_timestamp() if timestamp is None else timestamp
    label = stream if isinstance(stream, str) else "*"
    rows = conform_to_sink(guard_subjects(df.withColumns(extra), subjects, label), keep=tuple(extra))
    return log.append(rows, batch, list(order) or None, one_stream=isinstance(stream, str))


def publish_messages(log: MessageLog, df: DataFrame, stream: str, batch: str) -> int:
    """Append in-memory messages (subject, dateTime, content) with their origin time as header."""
    return publish(log, publish_rows(df), stream, batch)


def publish_text(log: MessageLog, df: DataFrame, stream: str, subject: str, text: str, batch: str) -> int:
    """Append a text column as messages of one subject."""
    return publish(log, text_rows(df, subject, text), stream, batch)


def batch_name(batch: DataFrame, batch_id: int, writer: str | None) -> str:
    """Id under which a micro-batch is appended.

    Without a writer name it contains the streaming query's id, which lives in the checkpoint: a
    replayed batch has the same name, and a query on a new checkpoint never meets an old one.
    """
    name = writer or batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not name:
        raise ValueError("Outside a streaming query the option 'writer' is needed")
    return f"{name}-{batch_id}"


def batch_writer(options: Mapping[str, object]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that appends each micro-batch once, also when it is replayed."""
    parsed = SinkOptions.from_options(options)
    index = LogIndex(parsed.path.rstrip("/"))  # lives as long as the query: each batch reads new manifests only

    def write(batch: DataFrame, batch_id: int) -> None:
        log = MessageLog(batch.sparkSession, parsed.path, index)
        publish(log, batch, parsed.stream, batch_name(batch, batch_id, parsed.writer), parsed.subjects)

    return write


def write_stream(df: DataFrame, **options: object) -> DataStreamWriter:
    """``writeStream`` into a message log; set checkpoint and trigger on the result and start it."""
    return df.writeStream.foreachBatch(batch_writer(options))
