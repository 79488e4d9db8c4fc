"""Message projections: delivery envelopes, text envelopes, sink rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgflow import schemas
from msgflow.functions import envelope as E
from msgflow.options import DEFAULT_DATETIME_FORMAT
from msgflow.operators.planning import with_offset

ENVELOPE_COLUMNS = schemas.ENVELOPE.names


def deliver(
    messages: DataFrame,
    heads: dict[str, int],
    consumer: str,
    domain: str = "",
    account: str = "",
    delivered: Column | None = None,
) -> DataFrame:
    """Log messages as one consumer receives them: full envelopes with a reply subject.

    ``heads`` gives the last sequence number per stream, from which pending is counted.
    """
    delivered = (F.lit(1) if delivered is None else delivered).cast("long")
    seq = F.col("streamSeq")
    pending = F.col("_head") - seq
    nanos = E.epoch_micros(F.col("timestamp")) * 1000
    reply = E.reply_subject(
        F.lit(domain), F.lit(account), F.col("stream"), F.lit(consumer), delivered, seq, seq, nanos, pending
    )
    return with_offset(messages, heads, "_head").select(
        "subject",
        reply.alias("replyTo"),
        "content",
        "headers",
        F.lit(domain).alias("domain"),
        "stream",
        F.lit(consumer).alias("consumer"),
        delivered.alias("delivered"),
        "streamSeq",
        seq.alias("consumerSeq"),
        E.event_time(nanos).alias("timestamp"),
        pending.alias("pending"),
    )


def reply_metadata(messages: DataFrame, reply: str = "replyTo") -> DataFrame:
    """Add the fields of the reply subject as typed columns."""
    column = F.col(reply)
    return messages.withColumns(
        {
            "domain": E.reply_field(column, "domain"),
            "stream": E.reply_field(column, "stream"),
            "consumer": E.reply_field(column, "consumer"),
            "delivered": E.reply_field(column, "delivered"),
            "streamSeq": E.reply_field(column, "streamSeq"),
            "consumerSeq": E.reply_field(column, "consumerSeq"),
            "timestamp": E.event_time(E.reply_field(column, "nanos")),
            "pending": E.reply_field(column, "pending"),
        }
    )


def to_full_envelope(messages: DataFrame) -> DataFrame:
    """subject, replyTo, content, headers to the twelve envelope columns."""
    return reply_metadata(messages).select(*ENVELOPE_COLUMNS)


def to_text5(envelopes: DataFrame, received_at: Column, pattern: str = DEFAULT_DATETIME_FORMAT) -> DataFrame:
    """Full envelopes as five text columns; ``received_at`` is the receive time to print."""
    return envelopes.select(
        "subject",
        E.format_time(received_at, pattern).alias("dateTime"),
        E.utf8_text(F.col("content")).alias("content"),
        E.headers_json(F.col("headers")).alias("headers"),
        _metadata_json().alias("jsMetadata"),
    )


def to_text3(envelopes: DataFrame) -> DataFrame:
    """Full envelopes as subject, broker time in ISO form and US-ASCII content."""
    return envelopes.select(
        "subject",
        E.iso_time(F.col("timestamp")).alias("dateTime"),
        E.ascii_text(F.col("content")).alias("content"),
    )


def to_message_json(
    envelopes: DataFrame, received_at: Column, pattern: str = DEFAULT_DATETIME_FORMAT, out: str = "message"
) -> DataFrame:
    """Add the whole message as JSON text."""
    return envelopes.withColumn(
        out,
        E.message_json(
            F.col("subject"),
            E.format_time(received_at, pattern),
            E.utf8_text(F.col("content")),
            F.col("headers"),
            _metadata_json(),
        ),
    )


def _metadata_json() -> Column:
    return E.metadata_json(
        F.col("stream"),
        F.col("streamSeq"),
        F.col("consumerSeq"),
        F.col("delivered"),
        F.col("pending"),
        F.col("timestamp"),
    )


def conform_to_sink(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Match the sink schema by name: reorder, drop extras (but ``keep``), add missing headers.

    A missing subject or data column fails when the query is built, a null in one when it runs.
    """
    for name in ("subject", "data"):
        if name not in df.columns:
            raise ValueError(f"The sink needs a column '{name}'")
    checked = df.withColumns(
        {
            "subject": _not_null("subject", F.lit("")),
            "data": _not_null("data", F.lit(b"")),
        }
    )
    kept = [f for f in checked.schema.fields if f.name in keep]
    return checked.to(T.StructType([*schemas.SINK.fields, *kept]))


def _not_null(name: str, filler: Column) -> Column:
    """The column with a non-nullable type; a null value in it fails the query."""
    present = F.assert_true(F.col(name).isNotNull(), f"null {name}").isNull()
    return F.coalesce(F.when(present, F.col(name)), filler)


def legacy_sink_rows(df: DataFrame, charset: str = "UTF-8") -> DataFrame:
    """First three columns by position (subject, time, text) as sink rows; all others are dropped."""
    if len(df.columns) < 3:
        raise ValueError("The positional sink needs three columns: subject, dateTime, content")
    subject, date_time, content = (F.col(f"`{c}`") for c in df.columns[:3])
    encode = E.ascii_bytes if charset.upper() == "US-ASCII" else E.utf8_bytes
    return df.select(
        subject.cast("string").alias("subject"),
        encode(content.cast("string")).alias("data"),
        E.with_origin(None, date_time).alias("headers"),
    )


def publish_rows(df: DataFrame) -> DataFrame:
    """In-memory messages (subject, dateTime, content bytes) as sink rows with the origin time."""
    return df.select("subject", F.col("content").alias("data"), E.with_origin(None, F.col("dateTime")).alias("headers"))


def text_rows(df: DataFrame, subject: str, text: str) -> DataFrame:
    """A text column as messages of one subject, UTF-8, with empty headers."""
    return df.select(
        F.lit(subject).alias("subject"), E.utf8_bytes(F.col(text)).alias("data"), E.no_headers().alias("headers")
    )
