"""Options of the source and the sink, parsed and checked once on the driver."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

# Accepted option words and defaults.
CODECS = ("none", "uncompressed", "zlib")
ENVELOPES = ("full", "text5", "text3")
# Messages per Parquet row group of a log, and per Spark partition of the source.
LOG_ROW_GROUP = 65_536
DEFAULT_DATETIME_FORMAT = "MM/dd/yyyy - HH:mm:ss Z"


class _Reader:
    """Case-insensitive view of an option map with typed getters."""

    def __init__(self, options: Mapping[str, object]):
        self._values = {str(k).lower(): str(v) for k, v in options.items() if v is not None}

    def required(self, key: str) -> str:
        if not self._values.get(key):
            raise ValueError(f"Please specify '{key}'")
        return self._values[key]

    def text(self, key: str, default: str | None = None) -> str | None:
        return self._values.get(key, default)

    def integer(self, key: str, default: int) -> int:
        raw = self._values.get(key)
        if raw is None:
            return default
        try:
            return int(raw.strip())
        except ValueError:
            raise ValueError(f"Option '{key}' must be a whole number, got '{raw}'") from None

    def number(self, key: str) -> float | None:
        raw = self._values.get(key)
        if raw is None:
            return None
        try:
            return float(raw)
        except ValueError:
            raise ValueError(f"Option '{key}' must be a number, got '{raw}'") from None

    def boolean(self, key: str, default: bool) -> bool:
        raw = self._values.get(key)
        if raw is None:
            return default
        word = raw.strip().lower()
        if word not in ("true", "false"):
            raise ValueError(f"Option '{key}' must be true or false, got '{raw}'")
        return word == "true"

    def choice(self, key: str, default: str, allowed: tuple[str, ...]) -> str:
        word = (self._values.get(key) or default).strip().lower()
        if word not in allowed:
            raise ValueError(f"Option '{key}' must be one of {', '.join(allowed)}, got '{word}'")
        return word

    def names(self, key: str) -> tuple[str, ...]:
        parts = (self._values.get(key) or "").split(",")
        return tuple(p.strip() for p in parts if p.strip())


def _positive(key: str, value: int) -> int:
    if value < 1:
        raise ValueError(f"Option '{key}' must be at least 1, got {value}")
    return value


@dataclass(frozen=True)
class SourceOptions:
    path: str
    streams: tuple[str, ...]
    consumer: str | None = None
    create_consumer: bool = True
    codec: str = "none"
    strict: bool = True
    ack_wait: int = 90
    max_ack_pending: int = 1000
    max_request_batch: int = 100
    subjects: tuple[str, ...] = ()
    batch_size: int = 1000
    partition_rows: int = LOG_ROW_GROUP
    max_partitions: int = 100_000
    max_batch_rows: int | None = None
    listeners: int = 1
    reset_on_restart: bool = False
    ack_none: bool = False
    idle_timeout: float | None = None
    datetime_format: str = DEFAULT_DATETIME_FORMAT
    envelope: str = "full"
    columns: tuple[str, ...] = ()
    domain: str = ""
    account: str = ""

    @classmethod
    def from_options(cls, options: Mapping[str, object]) -> SourceOptions:
        read = _Reader(options)
        path = read.required("path")
        prefix = read.text("stream_prefix")
        if prefix:
            count = _positive("num_partitions", read.integer("num_partitions", 1))
            streams = tuple(f"{prefix}-{n}" for n in range(count))
        else:
            streams = (read.required("stream"),)
        bound = read.integer("max_batch_rows", 0)
        reset = read.boolean("reset_on_restart", False)
        if bound and reset:
            raise ValueError("Options 'max_batch_rows' and 'reset_on_restart' exclude each other")
        return cls(
            path=path,
            streams=streams,
            consumer=read.text("consumer"),
            create_consumer=read.boolean("create_consumer", True),
            codec=read.choice("codec", "none", CODECS),
            strict=read.boolean("strict", True),
            ack_wait=read.integer("ack_wait", 90),
            max_ack_pending=read.integer("max_ack_pending", 1000),
            max_request_batch=_positive("max_request_batch", read.integer("max_request_batch", 100)),
            subjects=read.names("subjects"),
            batch_size=_positive("batch_size", read.integer("batch_size", 1000)),
            max_partitions=_positive("max_partitions", read.integer("max_partitions", 100_000)),
            partition_rows=_positive("partition_rows", read.integer("partition_rows", LOG_ROW_GROUP)),
            max_batch_rows=_positive("max_batch_rows", bound) if bound else None,
            listeners=_positive("listeners", read.integer("listeners", 1)),
            reset_on_restart=reset,
            ack_none=read.boolean("ack_none", False),
            idle_timeout=read.number("idle_timeout"),
            datetime_format=read.text("datetime_format", DEFAULT_DATETIME_FORMAT),
            envelope=read.choice("envelope", "full", ENVELOPES),
            columns=read.names("columns"),
            domain=read.text("domain", ""),
            account=read.text("account", ""),
        )


@dataclass(frozen=True)
class SinkOptions:
    path: str
    stream: str
    subjects: tuple[str, ...] = ()
    writer: str | None = None

    @classmethod
    def from_options(cls, options: Mapping[str, object]) -> SinkOptions:
        read = _Reader(options)
        return cls(
            path=read.required("path"),
            stream=read.required("stream"),
            subjects=read.names("subjects"),
            writer=read.text("writer"),
        )
