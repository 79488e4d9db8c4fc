import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from msgflow.functions import subjects as S
from msgflow.operators import routing as R
from tests.helpers import messages


def matches(pattern, subject):
    """Token-by-token matching, written independently of the regular expressions."""
    p, s = pattern.split("."), subject.split(".")
    for i, token in enumerate(p):
        if token == ">":
            return len(s) > i
        if i >= len(s) or token not in ("*", s[i]):
            return False
    return len(p) == len(s)


PATTERNS = ["a", "a.b", "*", "a.*", "a.>", ">", "*.b", "a.*.c", "*.*", "*.>", "a.b.>", "a+b.c", "b.a.c"]
SUBJECTS = ["a", "b", "a.b", "a.c", "a.b.c", "b.b", "a.x.c", "a.b.c.d", "ab", "a+b.c", "aab.c", "b.a.c", "a.bc"]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_regex_and_spark_predicate(spark, pattern):
    expected = sorted(s for s in SUBJECTS if matches(pattern, s))
    assert sorted(s for s in SUBJECTS if re.match(S.pattern_regex(pattern), s)) == expected
    df = spark.createDataFrame([(s,) for s in SUBJECTS], "subject string")
    assert sorted(r[0] for r in R.filter_subjects(df, pattern).collect()) == expected


def test_lists_and_empty_lists(spark):
    df = spark.createDataFrame([(s,) for s in SUBJECTS], "subject string")
    got = {r[0] for r in R.filter_subjects(df, " a , *.b,, ").collect()}
    assert got == {"a", "a.b", "b.b"}
    assert R.filter_subjects(df, "").count() == len(SUBJECTS)


@pytest.mark.parametrize("bad", ["a..b", ">.a", ".a", "a."])
def test_bad_patterns(bad):
    with pytest.raises(ValueError):
        S.parse_patterns(bad)


def test_exact_and_prefix_tests_reach_the_scan(spark, log):
    from msgflow.sources.sink import publish

    publish(log, messages(spark, [(s, "x") for s in SUBJECTS]), "ST", "b")
    for pattern, pushed in (("a.b", "EqualTo(subject,a.b)"), ("a.b,b", "In(subject"), ("a.b.*", "StringStartsWith(subject,a.b.)")):
        plan = R.filter_subjects(log.scan(), pattern)._jdf.queryExecution().executedPlan().toString()
        assert pushed in plan.split("PushedFilters:")[1], pattern


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
def test_pattern_join_against_brute_force(spark, monkeypatch, broadcast_rows):
    import msgflow.session

    monkeypatch.setattr(msgflow.session, "BROADCAST_ROWS", broadcast_rows)
    rng = random.Random(3)
    words = ["a", "b", "c"]
    subjects = [".".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(200)] + ["a.a"] * 300
    patterns = sorted({".".join(rng.choice([*words, "*"]) for _ in range(rng.randint(1, 4))) for _ in range(60)})
    patterns += sorted({p + ".>" for p in patterns[::3]}) + [">"]
    left = spark.createDataFrame(list(enumerate(subjects)), "id int, subject string")
    right = spark.createDataFrame([(p,) for p in patterns], "pattern string")
    got = sorted((r.id, r.pattern) for r in R.match_patterns(left, right).collect())
    expected = sorted((i, p) for (i, s), p in itertools.product(enumerate(subjects), patterns) if matches(p, s))
    assert got == expected


def test_pattern_join_without_patterns(spark):
    left = spark.createDataFrame([(1, "a")], "id int, subject string")
    right = spark.createDataFrame([], "pattern string")
    assert R.match_patterns(left, right).collect() == []


def test_partition_names_and_routing(spark):
    df = spark.createDataFrame([("app.3.log",), ("app.x.log",), ("app",)], "subject string")
    rows = {r.subject: r.stream for r in R.route_by_token(df, "P", 2).collect()}
    assert rows == {"app.3.log": "P-3", "app.x.log": None, "app": None}
    row = spark.range(1).select(
        S.partition_stream("P", F.lit(4)).alias("a"),
        S.partition_number(F.lit("my-stream-12")).alias("b"),
        S.partition_number(F.lit("plain")).alias("c"),
        S.partition_subject(F.lit(2), "lead", "tail").alias("d"),
        S.partition_subject(F.lit(2)).alias("e"),
    ).collect()[0]
    assert tuple(row) == ("P-4", 12, None, "lead.2.tail", "2")


def test_fan_out(spark):
    out = R.fan_out(messages(spark, [("old", "m")]), F.lit("x, y,,z "))
    assert sorted((r.subject, bytes(r.data)) for r in out.collect()) == [("x", b"m"), ("y", b"m"), ("z", b"m")]


def test_guard(spark):
    df = messages(spark, [("done.a", "1"), ("other", "2")])
    assert [r.subject for r in R.off_stream(df, "done.>").collect()] == ["other"]
    with pytest.raises(Exception, match="'other' is not in stream 'ST'"):
        R.guard_subjects(df, "done.>", "ST").collect()
    assert R.guard_subjects(df.where("subject != 'other'"), "done.>", "ST").count() == 1
    assert R.guard_subjects(df, "").count() == 2


@pytest.mark.parametrize(
    ("pattern", "subject", "expected"),
    [("(.+)", "subject1", "done.subject1"), ("subject.(.+)", "subject.0", "done.0"), ("subject.(.+)", "subjectX7", "done.7")],
)
def test_rewrite(spark, pattern, subject, expected):
    from msgflow.functions.envelope import rewrite_subject

    got = spark.range(1).select(rewrite_subject(F.lit(subject), pattern, "done.$1")).collect()[0][0]
    assert got == expected


def test_empty_tokens_match_no_wildcard_in_filter_and_join(spark):
    subjects = ["a..b", "a.b.", ".a", "a.x.b", "a.", "a..", "a.b.c", "", "."]
    df = spark.createDataFrame([(s,) for s in subjects], "subject string")
    for pattern in ("a.*.b", "a.>", "*.*", ">", "*"):
        table = spark.createDataFrame([(pattern,)], "pattern string")
        joined = sorted(r.subject for r in R.match_patterns(df, table).collect())
        if pattern != ">":
            assert joined == sorted(r.subject for r in R.filter_subjects(df, pattern).collect()), pattern
    assert R.match_patterns(df, spark.createDataFrame([], "pattern string")).count() == 0


def test_broad_patterns_of_a_large_table_are_broadcast(spark, monkeypatch):
    """Beyond the bound the broad shapes stay on the broadcast side and the narrow ones are joined by shuffle."""
    from msgflow import session

    assert R.broad_and_narrow({">": 1, "=>": 4, "==": 90, "*=": 3}, 10) == ([">", "*=", "=>"], ["=="])
    for module in (R, session):
        monkeypatch.setattr(module, "BROADCAST_ROWS", 10)
    subjects = [f"e.{k % 40}" for k in range(400)] + ["f.1", "e", "e.1.2"]
    patterns = [">", "e.>", "*.7", *[f"e.{k}" for k in range(60)]]
    df = spark.createDataFrame(list(enumerate(subjects)), "id int, subject string")
    joined = R.match_patterns(df, spark.createDataFrame([(p,) for p in patterns], "pattern string"))
    got = sorted((r.id, r.pattern) for r in joined.collect())
    assert got == sorted((i, p) for (i, s), p in itertools.product(enumerate(subjects), patterns) if matches(p, s))
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 1 and plan.count("Join Inner") == 2
