import pytest
from pyspark.sql import functions as F

from msgflow.operators import planning as P
from tests.helpers import fill, keys


@pytest.fixture(params=[200, 0], ids=["predicates", "joins"])
def few(request, monkeypatch):
    monkeypatch.setattr(P, "FEW_STREAMS", request.param)


def test_ranges_are_half_open(spark, log, few):
    fill(log, 100, streams=2)
    got = keys(P.range_scan(log.scan(), {"S-0": 30}, {"S-0": 31, "S-1": 2, "S-9": 4}))
    assert got == [("S-0", 31), ("S-1", 1), ("S-1", 2)]
    assert keys(P.range_scan(log.scan(), {"S-0": 30}, {"S-0": 30})) == []


def test_offsets(spark, log):
    fill(log, 10, streams=3)
    got = {r.stream: r.last_seq for r in P.latest_offsets(log.scan()).collect()}
    assert got == log.heads() == {"S-0": 4, "S-1": 3, "S-2": 3}
    assert P.clamp_end({"S-0": 99, "S-1": 2, "gone": 7}, log.heads()) == {"S-0": 4, "S-1": 2, "gone": 0}
    assert P.start_offsets(["a", "b"], None) == {"a": 0, "b": 0}
    assert P.start_offsets(["a", "b"], {"a": 5}) == {"a": 5, "b": 0}
    assert P.start_offsets(["a"], {"a": 5}, reset_on_restart=True) == {"a": 0}
    assert P.start_offsets(["a"], {"a": 5}, reset_on_restart=True, first_batch=False) == {"a": 5}


@pytest.mark.parametrize("bad", [{"a": -1}, {"a": "7"}, {"a": True}, 5])
def test_bad_offsets(bad):
    with pytest.raises(ValueError):
        P.check_offsets(bad)


def test_slices(spark, log, few):
    fill(log, 105)
    start = {"S-0": 5}
    rest = P.range_scan(log.scan(), start, log.heads())
    counts = {r.slice: r["count"] for r in P.batch_slices(rest, start, 30).groupBy("slice").count().collect()}
    assert counts == {0: 30, 1: 30, 2: 30, 3: 10}
    assert P.slice_counts(start, log.heads(), 30) == {"S-0": 4}


def test_listener_shares_are_disjoint_and_complete(spark, log):
    fill(log, 101)
    rows = P.listener_share(log.scan(), 4).select("listener", "streamSeq").collect()
    assert sorted(r.streamSeq for r in rows) == list(range(1, 102))
    assert {r.listener for r in rows} == {0, 1, 2, 3}


def test_next_fetch(spark, log, few):
    fill(log, 40, streams=2)
    assert keys(P.next_fetch(log.scan(), {"S-0": 18}, 3)) == [("S-0", 19), ("S-0", 20), ("S-1", 1), ("S-1", 2), ("S-1", 3)]
    assert len(keys(P.next_fetch(log.scan(), {}, 15, max_request_batch=2))) == 4


def test_beyond_keeps_streams_without_floor(spark, log, few):
    fill(log, 8, streams=2)
    assert keys(P.beyond(log.scan(), {"S-0": 3})) == [("S-0", 4), ("S-1", 1), ("S-1", 2), ("S-1", 3), ("S-1", 4)]
    assert P.beyond(log.scan(), {}).count() == 8


def test_stream_selection(spark):
    df = spark.createDataFrame([("P-0",), ("P-11",), ("P-x",), ("PP-1",), ("Q",)], "stream string")
    assert sorted(r[0] for r in P.select_streams(df, prefix="P").collect()) == ["P-0", "P-11"]
    assert sorted(r[0] for r in P.select_streams(df, ["Q", "P-0"]).collect()) == ["P-0", "Q"]


def test_with_offset(spark, few):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "stream string")
    got = {r.stream: r.o for r in P.with_offset(df, {"a": 4, "b": 0}, "o").collect()}
    assert got == {"a": 4, "b": 0, "c": 0}
    assert P.with_offset(df, {"a": 4}, "o").where(F.col("o") > 0).count() == 1
