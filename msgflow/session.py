"""Session helpers: the shared working folder, workers' access to the package, checked broadcasts."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import msgflow

# Tables up to this many narrow rows are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 200_000

_roots: dict[str, str] = {}


def workspace(spark: SparkSession) -> str:
    """Folder shared by driver and executors: spark.checkpoint.dir; a temporary one in local mode only."""
    app = spark.sparkContext.applicationId
    if app not in _roots:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
                raise ValueError("Set spark.checkpoint.dir to a folder that the driver and all executors share")
            root = tempfile.mkdtemp(prefix="msgflow-")
        _roots[app] = f"{root.rstrip('/')}/msgflow/{app}"
    return _roots[app]


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unique path below the workspace."""
    return f"{workspace(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def ship_package() -> None:
    """Let Python workers run this package's classes and functions without having it installed."""
    cloudpickle.register_pickle_by_value(msgflow)


def join_small(df: DataFrame, small: DataFrame, on: list[str], rows: int, how: str = "inner") -> DataFrame:
    """Join with a side whose row count is known: broadcast below the bound, shuffle above it."""
    if rows <= BROADCAST_ROWS:
        small = F.broadcast(small)
    return df.join(small, on, how)


@contextmanager
def state_partitions(spark: SparkSession) -> Iterator[None]:
    """Start stateful queries inside this block: state partitions in line with the cluster's cores.

    The number is fixed for the life of a checkpoint, and a query takes it from the session when it
    starts. A value the user has set is kept, whatever it is; only Spark's own default is replaced.
    """
    key = "spark.sql.shuffle.partitions"
    if key in spark.conf.getAll:
        yield
        return
    spark.conf.set(key, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.unset(key)
