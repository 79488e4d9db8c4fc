"""Payload decompression as an Arrow job on executors."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from msgflow.session import ship_package

# Codec words and what they do.
PLAIN_CODECS = ("none", "uncompressed")
ZLIB = "zlib"

# Recoded bytes put into one Arrow batch before the next one starts; payloads may grow a
# thousandfold, and a batch must stay below Arrow's 2 GiB offsets and the worker's memory. A worker
# holds a batch about three times: as Python values, as Arrow array and in the one handed on before.
MAX_BATCH_BYTES = 4 << 20


def check_codec(codec: str | None) -> str:
    """Codec word, or ValueError; called when a query is built, not when it runs."""
    word = (codec or "none").strip().lower()
    if word not in (*PLAIN_CODECS, ZLIB):
        raise ValueError(f"Unsupported codec '{codec}'")
    return word


def inflate_bytes(payload: bytes | None, strict: bool) -> tuple[bytes | None, bool]:
    """Decoded payload and whether decoding worked.

    A truncated stream gives the part that decodes and bytes after the stream's end are ignored.
    Corrupt input raises when strict, else the payload is returned as it came.
    """
    if payload is None:
        return None, True
    decoder = zlib.decompressobj()
    try:
        return decoder.decompress(payload), True
    except zlib.error:
        if strict:
            raise
        return payload, False


def recode_batch(
    batch: pa.RecordBatch, column: str, recode: Callable[[bytes | None], tuple[bytes | None, bool]], flag: str | None = None
) -> Iterator[pa.RecordBatch]:
    """The batch with one column recoded value by value, cut into pieces of bounded size."""
    position = batch.schema.get_field_index(column)
    source = batch.column(position)
    start, values, good, size = 0, [], [], 0

    def piece(upto: int) -> pa.RecordBatch:
        cut = batch.slice(start, upto - start)
        arrays = list(cut.columns)
        arrays[position] = pa.array(values, pa.binary())
        names = list(cut.schema.names)
        if flag is not None:
            arrays.append(pa.array(good, pa.bool_()))
            names.append(flag)
        return pa.RecordBatch.from_arrays(arrays, names)

    for i in range(batch.num_rows):
        value, ok = recode(source[i].as_py())
        grown = len(value or b"")
        if values and size + grown > MAX_BATCH_BYTES:
            made = piece(i)
            start, values, good, size = i, [], [], 0
            yield made
        values.append(value)
        good.append(ok)
        size += grown
    yield piece(batch.num_rows)


def inflate_batch(batch: pa.RecordBatch, column: str, strict: bool, flag: str | None = None) -> Iterator[pa.RecordBatch]:
    """The batch with one column inflated, cut into pieces of bounded decoded size."""
    return recode_batch(batch, column, lambda payload: inflate_bytes(payload, strict), flag)


def decode_payload(
    df: DataFrame, codec: str | None, column: str = "content", strict: bool = True, flag: str | None = None
) -> DataFrame:
    """Decode a binary column; ``flag`` names an optional column telling whether decoding worked.

    Strict fails the query on a corrupt payload, lenient keeps it as it is.
    """
    word = check_codec(codec)
    if word in PLAIN_CODECS:
        return df if flag is None else df.selectExpr("*", f"true as `{flag}`")
    fields = [
        T.StructField(f.name, T.BinaryType() if f.name == column else f.dataType, f.nullable) for f in df.schema
    ]
    if flag is not None:
        fields.append(T.StructField(flag, T.BooleanType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from inflate_batch(batch, column, strict, flag)

    ship_package()
    return df.mapInArrow(run, T.StructType(fields))
