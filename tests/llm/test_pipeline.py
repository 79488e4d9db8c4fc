import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline as P
from tests.llm import brute

SF = "/root/testdata/sf0.001"
LLM = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in LLM) == list(range(1, 14))
    assert "pipeline" in entry.queries() and P.ORACLE_SQL is None


@pytest.mark.parametrize("name", [n for n in LLM if n in entry.oracle_sql()])
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = entry.queries()[name](spark, SF)
    want = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.fetchall())


def test_stages_against_plain_versions(spark):
    """Each stage on what the stage before kept; the classifier's rejects are known from its own scores."""
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    columns, docs, rows = documents.columns, documents, {}
    for name, stage in P.STAGES:
        before = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        after = stage(spark, docs, SF)
        rows[name] = (before, after.collect())
        assert after.columns == columns + (["shard", "slot"] if name == "sharding" else [])
        docs = spark.createDataFrame([tuple(r) for r in rows[name][1]], after.schema)

    scores = entry.queries()["op6_weak_supervision"](spark, SF).collect()
    before, after = rows["toxicity"]
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in scores if r.score < 0.5)

    before, after = rows["near_duplicates"]
    groups = brute.near_groups([(i, t) for i, t, _ in before], 80)
    assert sorted(r.doc_id for r in after) == sorted(i for i, (_, first) in groups.items() if i == first)

    before, after = rows["decontamination"]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {i for i, t, _ in before if any(x in t for x in items)}
    assert {i for i, _, _ in before} - {r.doc_id for r in after} == leaked

    before, after = rows["mixing"]
    taken = brute.mix(before)[1]
    times = {i: sum(r.doc_id == i for r in after) for i, _, _ in before}
    assert all(taken[i] == times[i] * len(brute.words(t)) for i, t, _ in before)

    before, after = rows["sharding"]
    assert sorted((r.doc_id, r.text) for r in after) == sorted((i, t) for i, t, _ in before)
    sizes = [sum(r.shard == k for r in after) for k in range(24)]
    assert sum(sizes) == len(after) and max(sizes) - min(sizes) <= 1


def test_run_gives_the_rows_of_all_stages(spark):
    out = P.run(spark, SF)
    assert out.columns[-2:] == ["shard", "slot"] and out.count() > 100


def test_stages_without_rows(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in P.STAGES:
        assert stage(spark, documents.limit(0), SF).count() == 0
