import random

import pytest
from pyspark.sql import functions as F

from msgflow.llm.tables import connected_components, numbered


def plain(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize(
    "edges",
    [
        [(i, i + 1) for i in range(300)],
        [(300 - i, 299 - i) for i in range(300)],
        [(0, i) for i in range(1, 200)] + [(500, i) for i in range(150, 250)],
        [(7, 7), (1, 2), (2, 1), (2, 3), (9, 8)],
        [(random.Random(k).randrange(400), random.Random(k + 999).randrange(400)) for k in range(350)],
        [],
    ],
    ids=["chain", "falling", "stars", "loops", "random", "none"],
)
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    got = connected_components(df, "test").collect()
    assert len({r.node for r in got}) == len(got)
    assert {r.node: r.component for r in got} == {k: v for k, v in plain(edges).items() if any(k in e and e[0] != e[1] for e in edges)}


def test_numbers_are_gapless_in_order(spark):
    values = random.Random(1).sample(range(10_000), 1000)
    df = spark.createDataFrame([(v, str(v)) for v in values], "v long, t string").repartition(7)
    got = numbered(df, [F.col("v")], "test").collect()
    assert [r.v for r in sorted(got, key=lambda r: r.idx)] == sorted(values)
    assert sorted(r.idx for r in got) == list(range(1000))
