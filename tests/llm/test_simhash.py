import hashlib
import math
import random
import re

import xxhash
from pyspark.sql import functions as F

from msgflow.llm import simhash as S


def terms(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]


def spark_hash(text):
    return xxhash.xxh64_intdigest(text.encode(), seed=42)


def plain(rows):
    """Fingerprints as defined: slot counts over all texts, squared logarithms as weights, signed votes."""
    counts = {}
    for text in rows:
        for w in terms(text):
            counts[spark_hash(w) % S.SLOTS] = counts.get(spark_hash(w) % S.SLOTS, 0) + 1
    total = sum(counts.values()) or 1

    def fingerprint(text):
        votes = [0] * 64
        for w in terms(text):
            h = spark_hash(w)
            weight = math.floor(math.log2(total / counts.get(h % S.SLOTS, 1)) ** 2) + 1
            for i in range(64):
                votes[i] += weight if h >> i & 1 else -weight
        return sum(1 << i for i in range(64) if votes[i] > 0)

    return fingerprint


def check(df, rows):
    rows = sorted(rows)
    fingerprint = plain([t for _, t in rows])
    got = {r.doc_id: r for r in S.edit_report(df).collect()}
    assert len(got) == len(rows)
    prints = {i: fingerprint(t) for i, t in rows}
    for k, (i, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(text) // 4
        edited = text[: len(text) - n] + after[:n]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == f"{prints[i]:016x}" and r.edited_fingerprint == f"{fingerprint(edited):016x}"
        assert r.near_edited == 1 - bin(prints[i] ^ fingerprint(edited)).count("1") / 64
        assert r.near_next == 1 - bin(prints[i] ^ prints[rows[(k + 1) % len(rows)][0]]).count("1") / 64
        near = sum(bin(prints[i] ^ p).count("1") <= S.RADIUS for j, p in prints.items() if j != i)
        assert r.near_documents == (near if i % 50 == 0 else None)


def test_equals_plain_version(make):
    r = random.Random(1)
    pool = [f"Wörd{k}" for k in range(200)]
    rows = [(i * 5, " ".join(r.choice(pool) for _ in range(r.randrange(1, 80)))) for i in range(60)]
    rows += [(1001, rows[3][1]), (1050, rows[0][1]), (1002, None), (1003, ""), (1004, " \t"), (1100, "\U0001f600é a")]
    check(make(rows), rows)


def test_documents_of_the_tables(small, small_rows):
    check(small, small_rows)


def test_repeated_and_missing_ids(make):
    rows = [(1, "a b c d e f g h"), (1, "a b c d e f g h"), (None, "x y z w"), (2, "q r s t")]
    out = S.edit_report(make(rows, head="a", edited="b", idx="c"))
    assert sorted(r.doc_id or -1 for r in out.collect()) == [-1, 1, 1, 2]  # every row of the table is due


def test_empty_and_single(make):
    assert S.edit_report(make([])).count() == 0
    (r,) = S.edit_report(make([(50, "one two three four")])).collect()
    assert r.near_next == 1.0 and r.near_documents == 0


def test_block_tables_find_all_within_radius(spark):
    r = random.Random(2)
    base = [r.getrandbits(64) for _ in range(30)]
    every = base + [b ^ sum(1 << k for k in r.sample(range(64), r.randrange(1, 6))) for b in base for _ in range(6)]
    signed = [v - (1 << 64) if v >= 1 << 63 else v for v in every + base[:5]]
    df = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    got = S.within_radius(df.limit(40), df).collect()
    asked = {x.fingerprint for x in df.limit(40).collect()}
    want = {(a, b, bin((a ^ b) & (1 << 64) - 1).count("1")) for a in asked for b in set(signed)}
    assert sorted(map(tuple, got)) == sorted(x for x in want if x[2] <= 3)


def test_block_tables_with_smaller_radius(spark):
    df = spark.createDataFrame([(0,), (1,), (3,), (7,), (15,)], "fingerprint long")
    got = S.within_radius(df.where(F.col("fingerprint") == 0), df, radius=2).collect()
    assert sorted((r.found, r.distance) for r in got) == [(0, 0), (1, 1), (3, 2)]


def test_every_row_has_its_row(make, monkeypatch):
    monkeypatch.setattr(S, "REPEATS", 3)
    rows = [(50, "one two three")] * 8 + [(51, "four five")] + [(None, "six")] * 2
    got = [r.doc_id for r in S.edit_report(make(rows)).collect()]
    assert sorted(got, key=str) == sorted((i for i, _ in rows), key=str)
