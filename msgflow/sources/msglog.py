"""Streaming source ``msglog``: sequence ranges of one or more streams of a message log.

The offset is ``{stream: last sequence number}`` and comes from the log's manifests, so it never
depends on a counter kept in memory. The driver only plans ranges; executors read the Parquet files.

Spark tells a source only that the batch before the last one is done. So offsets also carry, as keys that no
stream can have, the consumer to move and the idle limit; ``SourceWatch`` reads them from the query's progress.

With ``max_batch_rows`` a batch ends before the head. Spark does not tell a Python source where the last batch ended when it
asks for the next end, so the reader keeps the end that it planned last. After a restart it does not know it, and its
first offset only names a plan: a small file with the batch's ends, written when Spark asks for the batch's
partitions and says where it starts. Such an offset is read like one with the ends themselves.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from msgflow import schemas
from msgflow.functions.envelope import REPLY_PREFIX
from msgflow.functions.subjects import is_exact, parse_patterns, pattern_regex
from msgflow.operators.codec import PLAIN_CODECS, inflate_batch
from msgflow.options import SourceOptions
from msgflow.sources import files
from msgflow.sources.consumers import ConsumerStore
from msgflow.sources.index import LogIndex


# Keys of an offset that are not streams: the consumer's folder, and the idle limit in seconds.
CONSUMER_KEY = "consumer:"
IDLE_KEY = "idle-seconds:"
# Key of an offset whose ends are in a file of the log; see above.
PLAN_KEY = "plan:"

# Messages per Arrow batch read from a file, fewer if they are long: as many as take about READ_BYTES on average.
ARROW_ROWS = 10_000
READ_BYTES = 4 << 20
# A column's pages are read through a buffer of this size, so that no column chunk lies in memory whole.
PAGE_BUFFER = 1 << 20


@dataclass(frozen=True)
class Slice:
    """Messages ``(after, upto]`` of one stream, all inside one data file."""

    stream: str
    file: str
    after: int
    upto: int
    end: int  # last sequence number of the stream in this batch


class SlicePartition(InputPartition):
    def __init__(self, slices: list[Slice], listener: int):
        self.slices = slices
        self.listener = listener


def stream_ends(offset: dict) -> dict[str, int]:
    """The ends of the streams that an offset stands for; none for a plan that was never made."""
    ends = {k: int(v) for k, v in offset.items() if not k.startswith((CONSUMER_KEY, IDLE_KEY, PLAN_KEY))}
    for key in offset:
        if key.startswith(PLAN_KEY):
            ends |= files.read_json(key.removeprefix(PLAN_KEY), {})
    return ends


def bounded_ends(start: dict[str, int], heads: dict[str, int], most: int) -> dict[str, int]:
    """Ends of a batch of at most ``most`` messages: streams with little left get it whole, the others share the rest evenly,
    and what an even share leaves over goes to the first ones."""
    left = {s: max(0, head - start.get(s, 0)) for s, head in heads.items()}
    ends, room = {}, most
    for place, stream in enumerate(sorted(left, key=lambda s: (left[s], s))):
        taken = min(left[stream], -(-room // (len(left) - place)))
        ends[stream] = start.get(stream, 0) + taken
        room -= taken
    return ends


def slice_rows(pending: int, options: SourceOptions) -> int:
    """Messages per Spark partition: whole fetches up to the wanted number, more if that gave too many."""
    wanted = max(options.partition_rows // options.batch_size, 1)
    needed = -(-pending // (options.batch_size * options.max_partitions))
    return options.batch_size * max(wanted, needed)


def plan_slices(
    files_of_stream: list[tuple[str, int, int, int]], stream: str, after: int, upto: int, size: int
) -> list[Slice]:
    """Cut ``(after, upto]`` into slices of at most ``size`` messages, none crossing a file."""
    slices = []
    for file, first, last, _ in files_of_stream:
        low, high = max(after, first - 1), min(upto, last)
        while low < high:
            cut = min(high, low + size)
            slices.append(Slice(stream, file, low, cut, upto))
            low = cut
    return slices


def share_slices(slices: list[Slice], listeners: int, max_partitions: int) -> list[SlicePartition]:
    """Deal the slices out to the listeners in turn; with very many, neighbours share a partition."""
    per_partition = max(1, -(-len(slices) // max_partitions))
    partitions = []
    for listener in range(listeners):
        share = slices[listener::listeners]
        for i in range(0, len(share), per_partition):
            partitions.append(SlicePartition(share[i : i + per_partition], listener))
    return partitions


class MessageLogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "msglog"

    def schema(self) -> StructType:
        columns = SourceOptions.from_options(self.options).columns
        known = {f.name: f for f in (*schemas.ENVELOPE, schemas.LISTENER)}
        unknown = [c for c in columns if c not in known]
        if unknown:
            raise ValueError(f"Unknown envelope columns: {', '.join(unknown)}")
        return StructType([known[c] for c in columns]) if columns else schemas.ENVELOPE

    def reader(self, schema: StructType) -> MessageLogReader:
        return MessageLogReader(SourceOptions.from_options(self.options))

    def streamReader(self, schema: StructType) -> MessageLogStreamReader:
        options = SourceOptions.from_options(self.options)
        if options.envelope != "full":
            raise ValueError("format('msglog') gives full envelopes; use msgflow.read_stream for text envelopes")
        return MessageLogStreamReader(options)


class MessageLogStreamReader(DataSourceStreamReader):
    def __init__(self, options: SourceOptions):
        self.options = options
        self.index = LogIndex(options.path)
        self.patterns = parse_patterns(options.subjects)
        self.columns = options.columns or tuple(schemas.ENVELOPE.names)
        self.store = ConsumerStore(options.path, options.consumer) if options.consumer else None
        if self.store is not None:
            settings = self.store.open(
                options.create_consumer,
                options.ack_wait,
                options.max_ack_pending,
                options.subjects,
                options.max_request_batch,
            )
            if not options.create_consumer:
                self.patterns = parse_patterns(settings.get("subjects", []))
        self.first_batch = True
        self.planned: dict[str, int] | None = None  # ends of the batch planned last, if this reader knows it
        self.given: dict | None = None  # the offset that stands for it
        self.run = uuid.uuid4().hex

    # -- driver -----------------------------------------------------------------

    def initialOffset(self) -> dict:
        floors = self.store.floors() if self.store else {}
        self.planned = {s: int(floors.get(s, 0)) for s in self.options.streams}
        return {k: v for k, v in self._offset(self.planned).items() if not k.startswith(IDLE_KEY)}

    def latestOffset(self) -> dict:
        """The ends of the next batch: the streams' heads, or as far as the limit goes."""
        heads = self._heads()
        if self.options.max_batch_rows is None:
            return self._offset(heads)
        if self.planned is None:
            return self._offset({f"{PLAN_KEY}{self.options.path}/plans/{self.run}.json": 0})
        ends = bounded_ends(self.planned, heads, self.options.max_batch_rows)
        return self.given if ends == self.planned and self.given else self._offset(ends)

    def _heads(self) -> dict[str, int]:
        heads = self.index.heads()
        return {s: int(heads.get(s, 0)) for s in self.options.streams}

    def _offset(self, ends: dict[str, int]) -> dict:
        offset = dict(ends)
        if self._acking():
            offset[CONSUMER_KEY + self.store.folder] = 0
        if self.options.idle_timeout is not None:
            # With the run in it, the first offset after a restart is a new one. It makes a batch, if an empty one, and
            # with it a progress report that names the limit.
            offset[f"{IDLE_KEY}{self.run}"] = int(self.options.idle_timeout * 60)
        return offset

    def _acking(self) -> bool:
        return self.store is not None and not self.options.ack_none

    def _ends(self, start: dict[str, int], end: dict) -> dict[str, int]:
        """The ends of a batch; a plan is made at its first reading and then stays as it is."""
        ends = stream_ends(end)
        for key in end:
            if key.startswith(PLAN_KEY) and not ends:
                most = self.options.max_batch_rows or sum(self._heads().values())
                ends = bounded_ends(start, self._heads(), most)
                files.write_json(key.removeprefix(PLAN_KEY), ends)
        return ends

    def ranges(self, start: dict, end: dict) -> dict[str, tuple[int, int]]:
        """``(after, upto)`` of every stream in a batch."""
        for offset in (start, end):
            if not isinstance(offset, dict) or any(not isinstance(v, int) or v < 0 for v in offset.values()):
                raise ValueError(f"Not a stream offset: {offset!r}")
        self.commit(start)  # a batch is planned from where the last one ended
        heads, begin = self._heads(), stream_ends(start)
        ends = self._ends(begin, end)
        self.planned, self.given = {s: max(ends.get(s, 0), begin.get(s, 0)) for s in self.options.streams}, end
        if not any(ends.get(s, 0) > begin.get(s, 0) for s in self.options.streams):
            return {}
        if self.options.reset_on_restart and self.first_batch:
            begin = {}
        self.first_batch = False
        return {s: (begin.get(s, 0), min(ends.get(s, 0), heads[s])) for s in self.options.streams}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        ranges = self.ranges(start, end)
        size = slice_rows(sum(max(0, upto - after) for after, upto in ranges.values()), self.options)
        found = self.index.files_between({s: a for s, (a, _) in ranges.items()}, {s: u for s, (_, u) in ranges.items()})
        slices: list[Slice] = []
        for stream, (after, upto) in ranges.items():
            slices.extend(plan_slices(found.get(stream, []), stream, after, upto, size))
        return share_slices(slices, self.options.listeners, self.options.max_partitions)

    def commit(self, end: dict) -> None:
        if self._acking():
            ends = stream_ends(end)
            self.store.advance({s: ends[s] for s in self.options.streams if ends.get(s)})

    # -- executors --------------------------------------------------------------

    def read(self, partition: SlicePartition) -> Iterator[pa.RecordBatch]:
        for run in _runs(partition.slices):
            yield from self._read_run(run, partition.listener)

    def _read_run(self, run: Slice, listener: int) -> Iterator[pa.RecordBatch]:
        system, path = files.open_fs(f"{self.options.path}/{run.file}")
        wanted = (ds.field("streamSeq") > run.after) & (ds.field("streamSeq") <= run.upto)
        subject_test = _subject_expression(self.patterns)
        if subject_test is not None:
            wanted = wanted & subject_test
        needed = {*self.columns, "subject"} if self.patterns else self.columns
        stored = [c for c in ("subject", "content", "headers") if c in needed]
        if {"timestamp", "replyTo"} & set(self.columns):
            stored.append("timestamp")
        inflate = "content" in self.columns and self.options.codec not in PLAIN_CODECS
        schema = pa.schema([_ARROW_ENVELOPE.field(c) for c in self.columns])
        for batch in _stored_batches(system, path, [*stored, "streamSeq"], wanted):
            made = pa.RecordBatch.from_arrays([self._column(c, batch, run, listener) for c in self.columns], schema=schema)
            if not inflate:
                yield made
                continue
            for piece in inflate_batch(made, "content", self.options.strict):
                yield pa.RecordBatch.from_arrays(piece.columns, schema=schema)

    def _column(self, name: str, batch: pa.RecordBatch, run: Slice, listener: int) -> pa.Array:
        """One envelope column of a batch of stored messages."""
        kind = _ARROW_ENVELOPE.field(name).type
        if name in ("subject", "content", "headers"):
            return batch.column(name).cast(kind)
        fixed = {"domain": self.options.domain, "stream": run.stream, "consumer": self.options.consumer, "delivered": 1, "listener": listener}
        if name in fixed:
            return pa.repeat(pa.scalar(fixed[name], kind), batch.num_rows)
        seq = batch.column("streamSeq").cast(pa.int64())
        if name in ("streamSeq", "consumerSeq"):
            return seq
        pending = pc.subtract(pa.scalar(run.end, pa.int64()), seq)
        if name == "pending":
            return pending
        micros = batch.column("timestamp").cast(pa.timestamp("us", tz="UTC")).cast(pa.int64())
        if name == "timestamp":
            return pc.multiply(pc.divide(micros, 1000), 1000).cast(kind)
        head = (REPLY_PREFIX, self.options.domain, self.options.account, run.stream, self.options.consumer or "", "1")
        seq_text = seq.cast(kind)
        nanos = pc.multiply(micros, 1000).cast(kind)
        return pc.binary_join_element_wise(".".join(head), seq_text, seq_text, nanos, pending.cast(kind), ".")


class RangePartition(InputPartition):
    def __init__(self, rows: list[tuple[str, int, int]]):
        self.rows = rows


class RangeStreamReader(MessageLogStreamReader):
    """The same batches without their messages: one row ``(stream, after, upto)`` per stream with new ones."""

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        rows = [(s, after, upto) for s, (after, upto) in self.ranges(start, end).items() if upto > after]
        return [RangePartition(rows)] if rows else []

    def read(self, partition: RangePartition) -> Iterator[tuple[str, int, int]]:
        yield from partition.rows


class MessageRangeSource(DataSource):
    """Streaming source ``msglog_ranges``: what each batch holds, for handlers that read the messages with Spark."""

    @classmethod
    def name(cls) -> str:
        return "msglog_ranges"

    def schema(self) -> StructType:
        return schemas.RANGES

    def streamReader(self, schema: StructType) -> RangeStreamReader:
        return RangeStreamReader(SourceOptions.from_options(self.options))


class MessageLogReader(DataSourceReader):
    """The same envelopes as a table: everything committed when the query starts."""

    def __init__(self, options: SourceOptions):
        self.stream = MessageLogStreamReader(replace(options, consumer=None, reset_on_restart=False, max_batch_rows=None))

    def partitions(self) -> list[InputPartition]:
        return self.stream.partitions({}, self.stream.latestOffset())

    def read(self, partition: SlicePartition) -> Iterator[pa.RecordBatch]:
        if partition is not None:  # an empty log has no partitions
            yield from self.stream.read(partition)


_ARROW_ENVELOPE = pa.schema(
    [
        ("subject", pa.string()),
        ("replyTo", pa.string()),
        pa.field("content", pa.binary(), nullable=False),
        ("headers", pa.map_(pa.string(), pa.list_(pa.string()))),
        ("domain", pa.string()),
        ("stream", pa.string()),
        ("consumer", pa.string()),
        ("delivered", pa.int64()),
        ("streamSeq", pa.int64()),
        ("consumerSeq", pa.int64()),
        ("timestamp", pa.timestamp("us", tz="UTC")),
        ("pending", pa.int64()),
        ("listener", pa.int64()),
    ]
)


def _runs(slices: list[Slice]) -> Iterator[Slice]:
    """Neighbouring slices of one file as one read."""
    current = None
    for s in slices:
        if current and current.file == s.file and current.upto == s.after:
            current = Slice(s.stream, s.file, current.after, s.upto, s.end)
            continue
        if current:
            yield current
        current = s
    if current:
        yield current


def _stored_batches(system: FileSystem, path: str, columns: list[str], wanted: ds.Expression) -> Iterator[pa.RecordBatch]:
    """The wanted rows of a data file, page by page: a dataset's scanner would hold row groups whole, and some ahead."""
    fragment = ds.ParquetFileFormat().make_fragment(path, system)
    with pq.ParquetFile(path, metadata=fragment.metadata, filesystem=system, buffer_size=PAGE_BUFFER) as file:
        for group in fragment.subset(wanted).row_groups:
            rows = batch_rows(file.metadata.row_group(group.id), columns)
            # Spark already runs one task per core.
            for batch in file.iter_batches(rows, row_groups=[group.id], columns=columns, use_threads=False):
                kept = batch.filter(wanted)
                if kept.num_rows:
                    yield kept


def batch_rows(group: pq.RowGroupMetaData, columns: list[str]) -> int:
    """Messages to read at once from a row group."""
    chunks = [group.column(i) for i in range(group.num_columns)]
    size = sum(c.total_uncompressed_size for c in chunks if c.path_in_schema.split(".")[0] in columns)
    return max(1, min(ARROW_ROWS, group.num_rows * READ_BYTES // max(size, 1)))


def _subject_expression(patterns: list[str]) -> ds.Expression | None:
    if not patterns:
        return None
    exact = [p for p in patterns if is_exact(p)]
    test = ds.field("subject").isin(exact) if exact else None
    for pattern in patterns:
        if not is_exact(pattern):
            match = pc.match_substring_regex(ds.field("subject"), pattern_regex(pattern))
            test = match if test is None else test | match
    return test
