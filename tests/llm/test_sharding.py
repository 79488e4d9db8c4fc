import zlib

from pyspark.sql import functions as F

from msgflow.llm import sharding

ROWS = [(i, f"text {i} " * (i % 5)) for i in range(500)] + [(1000, None), (1001, ""), (1002, "é\U0001f600"), (None, "x")]


def places(df, **options):
    return {(r.doc_id, r.text): (r.shard, r.slot) for r in sharding.shard(df, **options).collect()}


def test_report(make):
    rows = sharding.shard_report(make(ROWS), bucket_bytes=500).collect()
    texts = dict(ROWS)
    assert sorted(r.doc_id is None or r.doc_id for r in rows) == sorted(i is None or i for i, _ in ROWS)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)


def test_shards_are_even_and_slots_gapless(make):
    for bucket in (200, 5000, 1 << 24):
        slots = {}
        for shard, slot in places(make(ROWS), bucket_bytes=bucket).values():
            slots.setdefault(shard, []).append(slot)
        assert sorted(slots) == list(range(24))
        sizes = [len(v) for v in slots.values()]
        assert max(sizes) - min(sizes) <= 1
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_order_depends_on_rows_and_seed_only(make):
    first = places(make(ROWS), bucket_bytes=900)
    assert first == places(make(ROWS[::-1]).repartition(9), bucket_bytes=900)
    assert first != places(make(ROWS), bucket_bytes=900, seed=2)


def test_order_is_shuffled(make):
    rows = [(i, "same") for i in range(2000)]
    order = [i for i, _ in sorted(places(make(rows), shards=1).items(), key=lambda x: x[1])]
    ids = [i for i, _ in order]
    rising = sum(a < b for a, b in zip(ids, ids[1:]))
    assert 900 < rising < 1100


def test_fewer_rows_than_shards_and_empty(make):
    assert sharding.shard(make([])).count() == 0
    few = places(make([(1, "a"), (2, "b"), (3, None)]))
    assert all(slot == 0 for _, slot in few.values()) and len({s for s, _ in few.values()}) == 3


def test_columns_and_repeated_rows(make):
    df = make([(1, "a")] * 30 + [(2, "b")] * 3, shard="old", slot="old", bucket="x", n="y")
    out = sharding.shard(df)
    assert out.columns == [c for c in df.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    assert out.count() == 33 and out.select("shard", "slot").distinct().count() == 33


def test_written_shards(spark, make, tmp_path):
    sharding.write_shards(sharding.shard(make(ROWS), bucket_bytes=2000), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(ROWS) and back.select("shard").distinct().count() == 24


def test_crowd_of_equal_rows_is_scattered(make):
    """A third of all rows are equal: they spread over the buckets like other rows, and reruns agree."""
    rows = [(7, "same text")] * 600 + [(100 + i, f"text {i}") for i in range(1200)]
    df = make(rows)
    hashed = df.withColumn("__key", F.xxhash64("doc_id", "text"))
    keys = sharding._without_crowds(hashed, 1000, 1).where("doc_id = 7").select("__key").distinct().count()
    assert keys == 600
    first = sharding.shard(df, bucket_bytes=1000)
    slots = first.select("shard", "slot").collect()
    assert len(set(slots)) == 1800 and first.where("doc_id = 7").select("shard").distinct().count() == 24


def test_report_is_of_the_written_shards(make, monkeypatch):
    written = []
    kept = sharding.write_shards
    monkeypatch.setattr(sharding, "write_shards", lambda df, path: (written.append(path), kept(df, path)))
    assert sharding.shard_report(make(ROWS)).count() == len(ROWS) and len(written) == 1
