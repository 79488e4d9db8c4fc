import pytest

from msgflow.llm import mixing
from tests.llm import brute

ROWS = [(i, " ".join(["w"] * (1 + i * 7 % 23)), f"s{i % 4}") for i in range(120)]
ODD = [(200, None, "s1"), (201, "", "s2"), (202, "x\ty z" * 3, None), (203, "  one", "é"), (204, "w " * 900, "big")]


def taken(df):
    return {r.doc_id: (r.size, r.source_size, r.target, r.taken) for r in df.collect()}


def check(make, rows):
    targets, want = brute.mix(rows)
    got = taken(mixing.mix_report(make(rows)))
    assert set(got) == set(want)
    for i, text, source in rows:
        size, total, target, took = got[i]
        assert size == len(brute.words(text)) and total == targets[source][0]
        assert target == pytest.approx(targets[source][1]) and took == want[i]


def test_equals_plain_version(make):
    check(make, ROWS + ODD)


def test_hot_source(make):
    check(make, [(i, "a b c", "hot" if i % 3 == 0 else f"s{i}") for i in range(90)])


def test_taken_words_come_near_target(make):
    rows = [(i, "a " * (1 + i % 9), f"s{i % 3}") for i in range(600)]
    got = taken(mixing.mix_report(make(rows)))
    for source in ("s0", "s1", "s2"):
        own = [got[i] for i, _, s in rows if s == source]
        assert abs(sum(x[3] for x in own) - own[0][2]) <= 5
        assert all(x[3] <= 2 * x[0] for x in own)


def test_mixed_documents_are_repeated_whole(make):
    rows = ROWS + [(300, None, None)]
    df = make(rows, key="k", whole="w", cut="c", target="t", size="z", slice="q")
    want = brute.mix(rows)[1]
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    times = {}
    for r in mixed.collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
        assert (r.key, r.cut) == ("k", "c")
    for i, text, _ in rows:
        size = len(brute.words(text))
        assert size == 0 or times.get(i, 0) == want[i] / size


def test_repeated_rows_share_their_fate_and_reruns_agree(make):
    rows = ROWS + ROWS[:10]
    first = sorted(mixing.mix_report(make(rows)).collect())
    assert first == sorted(mixing.mix_report(make(rows[::-1]).repartition(7)).collect())
    by_id = {}
    for r in first:
        by_id.setdefault(r.doc_id, set()).add(r.taken)
    assert all(len(v) == 1 for v in by_id.values())


def test_empty(make):
    assert mixing.mix_report(make([])).count() == 0
    assert mixing.mix(make([])).count() == 0
    assert mixing.mix_report(make([(1, None, "a"), (2, "", None)])).where("taken != 0 or target != 0").count() == 0


def test_water_level(spark):
    sources = spark.createDataFrame([(10, 5), (100, 2), (100, 1)], "size long, weight int")
    level = mixing.water_level(sources, 150.0, 2)
    assert level == pytest.approx((150 - 20) / 3)
    assert mixing.water_level(sources, 1e6, 2) == float("inf")


def test_rows_without_doc_id_are_drawn_each_by_itself(make):
    """A source without doc_ids comes near its target, and reruns take the same rows."""
    rows = [(None, f"{'w ' * (1 + i % 9)}{i % 300}", "lost") for i in range(700)] + [(i, "a b c", "s1") for i in range(400)]
    report = mixing.mix_report(make(rows)).collect()
    own = [r for r in report if r.doc_id is None]
    assert len(own) == 700 and abs(sum(r.taken for r in own) - own[0].target) <= 5
    assert all(r.taken <= 2 * r.size for r in own)
    mixed = [sorted(r.text for r in mixing.mix(make(x).repartition(k)).collect()) for k, x in ((1, rows), (6, rows[::-1]))]
    assert mixed[0] == mixed[1]
    assert sum(len(brute.words(t)) for t in mixed[0]) == sum(r.taken for r in report)
