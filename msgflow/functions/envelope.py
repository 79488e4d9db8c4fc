"""Column expressions over messages: reply-subject metadata, headers, JSON text, times, text and bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First two tokens of a reply subject, and the order of the tokens after them.
REPLY_PREFIX = "$JS.ACK"
REPLY_FIELDS = (
    "domain",
    "account",
    "stream",
    "consumer",
    "delivered",
    "streamSeq",
    "consumerSeq",
    "nanos",
    "pending",
)
ORIGIN_HEADER = "originTimestamp"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

_EMPTY_HEADERS = "cast(map() as map<string,array<string>>)"


def epoch_micros(ts: Column) -> Column:
    """Microseconds since the epoch of a zoned timestamp."""
    return F.unix_micros(ts)


def micros_of_ntz(ts: Column) -> Column:
    """Microseconds since the epoch of a zone-less timestamp read as UTC, whatever the session zone is."""
    return F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), ts)


def event_time(nanos: Column) -> Column:
    """Nanoseconds since the epoch as a timestamp cut to whole milliseconds."""
    return F.timestamp_millis(F.call_function("div", nanos, F.lit(1_000_000)))


def reply_subject(
    domain: Column,
    account: Column,
    stream: Column,
    consumer: Column,
    delivered: Column,
    stream_seq: Column,
    consumer_seq: Column,
    nanos: Column,
    pending: Column,
) -> Column:
    parts = (domain, account, stream, consumer, delivered, stream_seq, consumer_seq, nanos, pending)
    return F.concat_ws(".", F.lit(REPLY_PREFIX), *[p.cast("string") for p in parts])


def reply_field(reply: Column, name: str) -> Column:
    """One field of a reply subject; null when the subject has too few tokens."""
    position = 3 + REPLY_FIELDS.index(name)
    token = F.try_element_at(F.split(reply, r"\."), F.lit(position))
    if name in ("delivered", "streamSeq", "consumerSeq", "nanos", "pending"):
        return token.try_cast("long")
    return token


def headers_from_pairs(pairs: Column) -> Column:
    """array<struct<key,value>> to a multi-valued header map in order of first use; null without headers."""
    keys = F.array_distinct(F.transform(pairs, lambda p: p["key"]))
    values = F.transform(
        keys,
        lambda k: F.transform(F.filter(pairs, lambda p: p["key"] == k), lambda p: p["value"]),
    )
    return F.when(F.size(pairs) > 0, F.map_from_arrays(keys, values))


def json_string(text: Column) -> Column:
    """Text as a quoted and escaped JSON string."""
    wrapped = F.to_json(F.struct(text.alias("v")))
    return wrapped.substr(F.lit(6), F.length(wrapped) - 6)


def headers_json(headers: Column) -> Column:
    """Headers as ``{ "k": "v1,v2", ... }``; null headers stay null."""
    entries = F.transform(
        F.map_entries(headers),
        lambda e: F.concat(json_string(e["key"]), F.lit(": "), json_string(F.array_join(e["value"], ","))),
    )
    return F.concat(F.lit("{ "), F.array_join(entries, ", "), F.lit(" }"))


def metadata_json(
    stream: Column, stream_seq: Column, consumer_seq: Column, delivered: Column, pending: Column, ts: Column
) -> Column:
    """Delivery metadata as JSON text in the fixed spacing."""
    return F.concat(
        F.lit('{"jsMetaData": {"stream" : '),
        json_string(stream),
        F.lit(', "streamSeq" :  '),
        stream_seq.cast("string"),
        F.lit(', "consumerSeq" : '),
        consumer_seq.cast("string"),
        F.lit(', "delivered" : '),
        delivered.cast("string"),
        F.lit(', "pending" : '),
        pending.cast("string"),
        F.lit(', "timestamp" : "'),
        iso_time(ts),
        F.lit('"}}'),
    )


def message_json(subject: Column, date_time: Column, payload: Column, headers: Column, metadata: Column) -> Column:
    """A whole message as JSON text; absent headers or metadata print as null."""
    return F.concat(
        F.lit('{"subject": '),
        json_string(subject),
        F.lit(', "Datetime": '),
        json_string(date_time),
        F.lit(', "payload": '),
        json_string(payload),
        F.lit(', "headers": '),
        F.coalesce(headers_json(headers), F.lit("null")),
        F.lit(', "js-metadata": '),
        F.coalesce(metadata, F.lit("null")),
        F.lit("}"),
    )


def format_time(ts: Column, pattern: str) -> Column:
    return F.date_format(ts, pattern)


def iso_time(ts: Column) -> Column:
    """ISO date and time with offset; always six fraction digits."""
    return F.date_format(ts, ISO_FORMAT)


def utf8_text(content: Column) -> Column:
    """Bytes taken as UTF-8 without a check."""
    return content.cast("string")


def ascii_text(content: Column) -> Column:
    """Bytes as US-ASCII; every byte above 0x7f becomes the replacement character."""
    return F.regexp_replace(F.decode(content, "ISO-8859-1"), r"[\x80-\xff]", "�")


def utf8_bytes(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def ascii_bytes(text: Column) -> Column:
    """Text as US-ASCII; every character outside it becomes a question mark."""
    return F.encode(F.regexp_replace(text, r"[^\x00-\x7f]", "?"), "US-ASCII")


def no_headers() -> Column:
    return F.expr(_EMPTY_HEADERS)


def with_origin(headers: Column | None, date_time: Column) -> Column:
    """Headers plus the origin-timestamp header; an earlier value of it is replaced."""
    origin = F.create_map(F.lit(ORIGIN_HEADER), F.array(date_time.cast("string")))
    if headers is None:
        return origin
    kept = F.map_filter(F.coalesce(headers, no_headers()), lambda k, _: k != ORIGIN_HEADER)
    return F.map_concat(kept, origin)


def rewrite_subject(subject: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(subject, pattern, replacement)
