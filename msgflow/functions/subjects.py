"""Subject patterns: ``*`` stands for one dot-separated token, a last ``>`` for one or more."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_REGEX_SPECIALS = set(r"\.^$|?*+()[]{}")


def parse_patterns(patterns: str | Iterable[str]) -> list[str]:
    """A comma-separated text or a list as clean patterns: trimmed, empties dropped, no repeats."""
    parts = patterns.split(",") if isinstance(patterns, str) else list(patterns)
    cleaned = list(dict.fromkeys(p.strip() for p in parts if p and p.strip()))
    for pattern in cleaned:
        tokens = pattern.split(".")
        if "" in tokens or ">" in tokens[:-1]:
            raise ValueError(f"Bad subject pattern '{pattern}'")
    return cleaned


def is_exact(pattern: str) -> bool:
    return not any(t in ("*", ">") for t in pattern.split("."))


def pattern_regex(pattern: str) -> str:
    """Anchored regular expression, valid in Java and RE2."""

    def token(t: str) -> str:
        if t == "*":
            return r"[^.]+"
        if t == ">":
            return r"[^.]+(\.[^.]+)*"
        return "".join("\\" + c if c in _REGEX_SPECIALS else c for c in t)

    return "^" + r"\.".join(token(t) for t in pattern.split(".")) + "$"


def literal_prefix(pattern: str) -> str:
    """Text every matching subject starts with."""
    tokens = pattern.split(".")
    fixed = []
    for t in tokens:
        if t in ("*", ">"):
            break
        fixed.append(t)
    text = ".".join(fixed)
    return text + "." if fixed and len(fixed) < len(tokens) else text


def subject_filter(patterns: str | Iterable[str], subject: Column | None = None) -> Column:
    """Predicate for 'the subject matches one of the patterns'; no patterns means no filter.

    Exact names become IN, wildcards get a starts-with test next to the regular expression, so that
    both reach the Parquet scan.
    """
    subject = F.col("subject") if subject is None else subject
    cleaned = parse_patterns(patterns)
    if not cleaned or ">" in cleaned:
        return F.lit(True) if not cleaned else subject.isNotNull()
    tests = []
    exact = [p for p in cleaned if is_exact(p)]
    if exact:
        tests.append(subject.isin(exact))
    for pattern in cleaned:
        if is_exact(pattern):
            continue
        test = subject.rlike(pattern_regex(pattern))
        prefix = literal_prefix(pattern)
        tests.append(subject.startswith(prefix) & test if prefix else test)
    return reduce(lambda a, b: a | b, tests)


def partition_stream(prefix: str, number: Column) -> Column:
    """Stream name ``<prefix>-<n>``."""
    return F.concat(F.lit(prefix + "-"), number.cast("string"))


def partition_number(stream: Column) -> Column:
    """Number of a partition stream; null when the name has none."""
    return F.nullif(F.regexp_extract(stream, r"-(\d+)$", 1), F.lit("")).cast("int")


def partition_subject(number: Column, lead: str = "", tail: str = "") -> Column:
    """Subject ``[lead.]<n>[.tail]``."""
    parts = [F.lit(lead)] if lead else []
    parts.append(number.cast("string"))
    if tail:
        parts.append(F.lit(tail))
    return F.concat_ws(".", *parts)


def subject_token(subject: Column, position: int) -> Column:
    """The position-th token of a subject, from 1, or from the end when negative; null if absent."""
    return F.try_element_at(F.split(subject, r"\."), F.lit(position))
