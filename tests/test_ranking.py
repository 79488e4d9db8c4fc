import random

import pytest
from pyspark.sql import functions as F

from msgflow.operators import ranking
from msgflow.operators.ranking import first_in_stream, previous_in_stream, rank_in_stream


def frame(spark):
    """Sparse sequence numbers; one stream holds most rows."""
    rng = random.Random(1)
    rows = [("hot", s, s * 10) for s in sorted(rng.sample(range(1, 5000), 900))]
    rows += [("cold", s, s * 10) for s in sorted(rng.sample(range(1, 5000), 40))]
    return rows, spark.createDataFrame(rows, "stream string, streamSeq bigint, value bigint")


@pytest.mark.parametrize("bits", [3, 8, 18])
def test_rank_and_previous(spark, bits):
    rows, df = frame(spark)
    expected_rank, expected_prev = {}, {}
    for stream in ("hot", "cold"):
        own = sorted(r for r in rows if r[0] == stream)
        for i, r in enumerate(own):
            expected_rank[r[:2]] = i + 1
            expected_prev[r[:2]] = own[i - 1][2] if i else None
    got = rank_in_stream(df, ["stream"], bits=bits).collect()
    assert {(r.stream, r.streamSeq): r["rank"] for r in got} == expected_rank
    got = previous_in_stream(df, ["stream"], F.col("value"), "prev", bits=bits).collect()
    assert {(r.stream, r.streamSeq): r.prev for r in got} == expected_prev


def test_first_k_both_ways(spark, monkeypatch):
    rows, df = frame(spark)
    expected = sorted([r for r in rows if r[0] == "hot"][:25] + [r for r in rows if r[0] == "cold"][:25])
    assert sorted(map(tuple, first_in_stream(df, ["stream"], 25).collect())) == expected
    monkeypatch.setattr(ranking, "MAP_SIDE_LIMIT", 5)
    assert sorted(tuple(r) for r in first_in_stream(df, ["stream"], 25).select(df.columns).collect()) == expected


def test_small_k_is_cut_before_the_shuffle(spark):
    _, df = frame(spark)
    plan = first_in_stream(df, ["stream"], 25)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_ties_order_rows_of_several_streams(spark):
    df = spark.createDataFrame([(s, n, 0) for n in (1, 2, 3) for s in ("b", "a")], "stream string, streamSeq bigint, k int")
    got = rank_in_stream(df, ["k"], ties=["stream"], bits=1).orderBy("rank").collect()
    assert [(r.streamSeq, r.stream) for r in got] == [(1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "a"), (3, "b")]
