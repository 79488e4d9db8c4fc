"""The message log: an append-only Parquet table of sequence-numbered messages.

Layout below the log's path::

    data/batch=<id>/stream=<name>/*.parquet   messages, sorted by streamSeq inside a file
    commits/<id>.parquet                      manifest of a finished batch
    consumers/<name>/*.json                   consumer settings and positions
    deliveries/, acks/                        delivery accounting, one folder per consumer and batch

One writer appends at a time. A batch id is written once: appending it again is a no-op, so a
replayed micro-batch leaves the log unchanged.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgflow import schemas
from msgflow.operators.planning import range_scan, with_offset
from msgflow.options import LOG_ROW_GROUP
from msgflow.session import join_small
from msgflow.sources import files
from msgflow.sources.index import LogIndex


STAGED = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        *schemas.SINK.fields,
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("_row", T.LongType()),
    ]
)


def _escaped(path: str) -> str:
    """A path with the signs escaped that Spark would read as a pattern."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)


class MessageLog:
    def __init__(self, spark: SparkSession, path: str, index: LogIndex | None = None):
        """``index`` is one kept from before: what it has read of the manifests is not read again."""
        self.spark = spark
        self.path = path.rstrip("/")
        self.index = index or LogIndex(self.path)

    # -- read -----------------------------------------------------------------

    def scan(self) -> DataFrame:
        """All committed messages as a table; stream and sequence predicates reach the Parquet scan."""
        if not self.index.heads():
            return self.spark.createDataFrame([], schemas.LOG).drop("batch")
        table = self.spark.read.schema(schemas.LOG).parquet(f"{self.path}/data")
        open_batches = self._uncommitted()
        if open_batches:
            table = table.where(~F.col("batch").isin(open_batches))
        return table.drop("batch")

    def scan_range(self, start: dict[str, int], end: dict[str, int]) -> DataFrame:
        """Messages in ``(start, end]`` of each stream, reading only the data files that can hold them.

        The files come from the manifests, so a short range of a huge log needs no listing of it.
        """
        self.index.refresh()
        found = self.index.files_between(start, end)
        chosen = [f"{self.path}/{file}" for entries in found.values() for file, *_ in entries]
        if not chosen:
            return self.spark.createDataFrame([], schemas.LOG).drop("batch")
        reader = self.spark.read.schema(schemas.LOG).option("basePath", f"{self.path}/data")
        return range_scan(reader.parquet(*[_escaped(f) for f in chosen]).drop("batch"), start, end)

    def heads(self) -> dict[str, int]:
        """Last sequence number per stream, from the manifests."""
        return self.index.heads()

    def heads_frame(self) -> DataFrame:
        rows = sorted(self.heads().items())
        return self.spark.createDataFrame(rows, "stream string, head bigint")

    def _uncommitted(self) -> list[str]:
        names = files.list_names(f"{self.path}/data")
        present = {n.split("=", 1)[1] for n in names if n.startswith("batch=")}
        return sorted(present - self.index.batches())

    # -- append ---------------------------------------------------------------

    def append(self, df: DataFrame, batch: str, order_by: list[str] | None = None, one_stream: bool = False) -> int:
        """Append messages and number them densely per stream; returns the number of new messages.

        ``df`` has stream, subject, data, headers, timestamp and the ``order_by`` columns that fix the
        order within a stream (default: input order).

        The batch is first written to a staged table, which freezes its order; then one row per task
        and stream gives each run of messages its first number. Rows are laid out by (stream, order)
        ranges, which splits a hot stream over many tasks; with ``one_stream`` and no order they stay
        where they are and nothing is shuffled. No task ever sees a whole stream.
        """
        if not re.fullmatch(r"[A-Za-z0-9._-]+", batch):
            raise ValueError(f"Bad batch id '{batch}'")
        if self.index.committed(batch):
            return 0
        staging = f"{self.path}/staging/{batch}"
        target = f"{self.path}/data/batch={batch}"
        heads = self.heads()
        runs = None
        try:
            self._stage(df, staging, order_by, one_stream)
            staged = self.spark.read.schema(STAGED).parquet(f"{staging}/rows")
            staged = staged.withColumn("_task", F.shiftright("_row", 33))
            runs = self._runs(staged).persist()
            expected = runs.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
            numbered = join_small(staged, self._shifts(runs, heads), ["_task", "stream"], runs.count()).select(
                "subject",
                F.col("data").alias("content"),
                "headers",
                "timestamp",
                (F.col("_row") + F.col("_shift")).alias("streamSeq"),
                "stream",
            )
            (
                numbered.sortWithinPartitions("stream", "streamSeq")
                .write.mode("overwrite")
                .option("parquet.block.row.count.limit", LOG_ROW_GROUP)
                # Without a dictionary the file tells how large the payloads are, also repeated ones; readers go by it.
                .option("parquet.enable.dictionary#content", "false")
                # A search for few subjects skips the row groups without them, also where their range spans everything.
                .option("parquet.bloom.filter.enabled#subject", "true")
                .option("parquet.bloom.filter.expected.ndv#subject", LOG_ROW_GROUP)
                .partitionBy("stream")
                .parquet(target)
            )
            return self._commit(batch, target, heads, expected)
        finally:
            if runs is not None:
                runs.unpersist()
            files.delete_folder(staging)

    def _stage(self, df: DataFrame, staging: str, order_by: list[str] | None, one_stream: bool) -> None:
        named = F.col("stream").isNotNull() & (F.col("stream") != "")
        error = F.raise_error(F.lit("A message has no stream; route or drop it before it is appended")).cast("string")
        df = df.withColumn("stream", F.when(named, F.col("stream")).otherwise(error))
        if order_by or not one_stream:
            # The input position breaks ties, so rows with equal order values can still be split.
            order = ["stream", *(order_by or []), "_position"]
            df = df.withColumn("_position", F.monotonically_increasing_id())
            df = df.repartitionByRange(*order).sortWithinPartitions(*order)
        df.select(
            "stream", "subject", "data", "headers", "timestamp", F.monotonically_increasing_id().alias("_row")
        ).write.mode("overwrite").parquet(f"{staging}/rows")

    def _runs(self, staged: DataFrame) -> DataFrame:
        """One row per (task, stream) run of staged rows: at most tasks + streams rows."""
        return staged.groupBy("_task", "stream").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))

    def _shifts(self, runs: DataFrame, heads: dict[str, int]) -> DataFrame:
        """What turns a run's row numbers into sequence numbers: earlier runs and the stream's head."""
        before = Window.partitionBy("stream").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
        earlier = F.coalesce(F.sum("_n").over(before), F.lit(0))
        shift = F.col("_head") + earlier + 1 - F.col("_first")
        return with_offset(runs, heads, "_head").select("_task", "stream", shift.alias("_shift"))

    def _commit(self, batch: str, target: str, heads: dict[str, int], expected: int) -> int:
        path = F.col("_metadata.file_path")
        written = (
            self.spark.read.schema("streamSeq bigint, stream string").parquet(target)
            if files.exists(target) and any(n.startswith("stream=") for n in files.list_names(target))
            else None
        )
        if written is None:
            entries = self.spark.createDataFrame(
                [], "stream string, file string, first_seq bigint, last_seq bigint, rows bigint"
            )
        else:
            entries = written.groupBy("stream", path.alias("file")).agg(
                F.min("streamSeq").alias("first_seq"),
                F.max("streamSeq").alias("last_seq"),
                F.count(F.lit(1)).alias("rows"),
            )
        # One row per data file, not per message.
        table = entries.toArrow()
        names = [unquote(f).rsplit("/data/batch=", 1)[-1] for f in table["file"].to_pylist()]
        paths = pa.array([f"data/batch={n}" for n in names], pa.string())
        table = table.set_column(table.schema.get_field_index("file"), "file", paths)
        rows = sum(table["rows"].to_pylist())
        if rows != expected:
            raise RuntimeError(f"Batch '{batch}' has {rows} of {expected} messages; it is not committed")
        if self.heads() != heads:
            raise RuntimeError(f"Another writer has appended to {self.path} meanwhile; append '{batch}' again")
        self.index.commit(batch, table)
        return rows
