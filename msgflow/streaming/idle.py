"""Following running queries: moving consumers with every batch that is done, stopping queries that get no messages."""

from __future__ import annotations

import json
import time

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from msgflow.sources.consumers import ConsumerStore
from msgflow.sources.msglog import CONSUMER_KEY, IDLE_KEY, stream_ends


class SourceWatch(StreamingQueryListener):
    """For all queries over message logs of one application.

    Each progress report names the offset up to which the batch is done, also the last batch of a run and one in
    which no message matched: that is where the consumer stands. Queries whose source has an idle limit are
    stopped after so long without a message.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.limits: dict[str, float] = {}
        self.last_message: dict[str, float] = {}

    def watch(self, query_id: str, seconds: float) -> None:
        self.limits[query_id] = seconds
        self.last_message.setdefault(query_id, time.monotonic())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        query = str(event.progress.id)
        for source in event.progress.sources:
            self._source(query, source.endOffset)
        if event.progress.numInputRows > 0:
            self.last_message[query] = time.monotonic()
        self._check(query)

    def onQueryIdle(self, event) -> None:
        self._check(str(event.id))

    def onQueryTerminated(self, event) -> None:
        self.limits.pop(str(event.id), None)
        self.last_message.pop(str(event.id), None)

    def _source(self, query: str, offset: str | None) -> None:
        try:
            ends = json.loads(offset or "null")
        except ValueError:
            return
        if not isinstance(ends, dict):
            return  # another kind of source
        for key, value in ends.items():
            if key.startswith(CONSUMER_KEY):
                ConsumerStore.at(key.removeprefix(CONSUMER_KEY)).advance(stream_ends(ends))
            elif key.startswith(IDLE_KEY):
                self.watch(query, value)

    def _check(self, query_id: str) -> None:
        if query_id not in self.limits or time.monotonic() - self.last_message[query_id] < self.limits[query_id]:
            return
        query = self.spark.streams.get(query_id)
        if query is not None and query.isActive:
            query.stop()


def stop_when_idle(spark: SparkSession, query: StreamingQuery, minutes: float | None) -> SourceWatch | None:
    """Watch a running query of any source; without a limit nothing is watched."""
    if minutes is None:
        return None
    listener = SourceWatch(spark)
    listener.watch(str(query.id), minutes * 60.0)
    spark.streams.addListener(listener)
    return listener
