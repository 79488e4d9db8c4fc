import zlib

import pyarrow as pa
import pytest

from msgflow.operators import codec
from msgflow.operators.codec import decode_payload, inflate_batch, recode_batch
from msgflow.plans.fixtures import deflate


def payloads(spark, values):
    rows = [(i, None if v is None else bytearray(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id int, content binary")


def decoded(df):
    return [None if r.content is None else bytes(r.content) for r in df.orderBy("id").collect()]


def test_round_trips(spark):
    long = b"0123456789abcdef" * 100_001
    values = [b"a short one", long, b""]
    df = payloads(spark, [zlib.compress(v) for v in values] + [None])
    assert decoded(decode_payload(df, "zlib")) == [*values, None]


def test_truncated_and_trailing_input(spark):
    whole = bytes(range(256)) * 40
    packed = zlib.compress(whole)
    got = decoded(decode_payload(payloads(spark, [packed[: len(packed) // 2], packed + b"trailing"]), "zlib"))
    assert whole.startswith(got[0]) and len(got[0]) < len(whole)
    assert got[1] == whole


def test_corrupt_input_strict_fails_lenient_keeps(spark):
    df = payloads(spark, [b"not zlib", zlib.compress(b"ok")])
    with pytest.raises(Exception, match="zlib|incorrect header"):
        decode_payload(df, "zlib").collect()
    lenient = decode_payload(df, "zlib", strict=False, flag="ok")
    assert decoded(lenient) == [b"not zlib", b"ok"]
    assert [r.ok for r in lenient.orderBy("id").collect()] == [False, True]


@pytest.mark.parametrize("word", ["none", "uncompressed", None, "NONE"])
def test_plain_codecs_do_nothing(spark, word):
    df = payloads(spark, [b"x"])
    assert decode_payload(df, word) is df


def test_unknown_codec_fails_when_built(spark):
    with pytest.raises(ValueError, match="gzip"):
        decode_payload(payloads(spark, [b"x"]), "gzip")


def test_output_batches_are_bounded(monkeypatch):
    monkeypatch.setattr(codec, "MAX_BATCH_BYTES", 1000)
    values = [b"a" * n for n in (600, 600, 5000, 10, 10, 990)]
    batch = pa.RecordBatch.from_pydict({"id": list(range(6)), "content": [zlib.compress(v) for v in values]})
    pieces = list(inflate_batch(batch, "content", True))
    assert [v for p in pieces for v in p.column("content").to_pylist()] == values
    assert [v for p in pieces for v in p.column("id").to_pylist()] == list(range(6))
    sizes = [sum(map(len, p.column("content").to_pylist())) for p in pieces]
    assert all(s <= 1000 or p.num_rows == 1 for s, p in zip(sizes, pieces, strict=True))


def test_inflated_pieces_are_small_for_a_worker():
    values = [bytes([n]) * (1 << 20) for n in range(24)]
    batch = pa.RecordBatch.from_pydict({"content": [zlib.compress(v) for v in values]})
    pieces = list(inflate_batch(batch, "content", True))
    assert [v for p in pieces for v in p.column("content").to_pylist()] == values
    assert max(p.nbytes for p in pieces) <= 5 << 20


def test_recoded_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(codec, "MAX_BATCH_BYTES", 1000)
    values = [None, b"", b"a" * 10, None, b"b" * 300, b"c" * 200]
    batch = pa.RecordBatch.from_pydict({"id": list(range(6)), "content": values})
    pieces = list(recode_batch(batch, "content", lambda v: (None if v is None else v * 3, True)))
    assert [v for p in pieces for v in p.column("content").to_pylist()] == [None if v is None else v * 3 for v in values]
    assert [p.column("id").to_pylist() for p in pieces] == [[0, 1, 2, 3, 4], [5]]


def test_deflate_keeps_rows_and_nulls(spark):
    values = [b"", None, b"x" * 3_000_000, bytes(range(256))]
    packed = deflate(payloads(spark, values), "content")
    assert [None if r is None else zlib.decompress(r) for r in decoded(packed)] == values
