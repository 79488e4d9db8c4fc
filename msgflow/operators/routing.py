"""Subject filters, pattern joins, partition routing, fan-out and stream guards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow.functions.subjects import (
    parse_patterns,
    partition_stream,
    subject_filter,
    subject_token,
)
from msgflow.session import BROADCAST_ROWS, join_small


def filter_subjects(df: DataFrame, patterns: str | list[str], subject: str = "subject") -> DataFrame:
    return df.where(subject_filter(patterns, F.col(subject)))


def match_patterns(df: DataFrame, patterns: DataFrame, pattern: str = "pattern", subject: str = "subject") -> DataFrame:
    """Join messages with a table of subject patterns, one row per message and matching pattern.

    A pattern's shape says which tokens are fixed and whether a tail follows; its key is the fixed
    tokens. Per shape in use a message has exactly one key, so the match is an equi-join and never
    compares all messages with all patterns.

    Patterns with few fixed tokens, such as ``>``, match a large share of all messages under one key. Shapes are broadcast
    from the broadest on as far as the bound for broadcasts goes; only the narrower rest of a larger table is joined by
    shuffle, so no broad pattern gathers its messages in one task.
    """
    tokens = F.split(F.col(pattern), r"\.")
    has_tail = F.element_at(tokens, -1) == ">"
    body = F.when(has_tail, F.slice(tokens, F.lit(1), F.size(tokens) - 1)).otherwise(tokens)
    shape = F.concat(
        F.array_join(F.transform(body, lambda t: F.when(t == "*", F.lit("*")).otherwise(F.lit("="))), ""),
        F.when(has_tail, F.lit(">")).otherwise(F.lit("")),
    )
    key = F.array_join(F.filter(body, lambda t: t != "*"), ".")
    keyed = patterns.withColumns({"_shape": shape, "_key": key})
    # A shape is a word of one sign per token, so only a few distinct ones exist.
    counts = keyed.groupBy("_shape").count().collect()
    shapes = [r["_shape"] for r in counts]
    if not shapes:
        return df.withColumn("_none", F.lit(0)).join(patterns.withColumn("_none", F.lit(1)), "_none").drop("_none")

    parts = F.split(F.col(subject), r"\.")

    def candidate(word: str) -> Column:
        fixed = word.rstrip(">")
        depth_ok = F.size(parts) > len(fixed) if word.endswith(">") else F.size(parts) == len(fixed)
        # Tokens under a wildcard must not be empty, as in the filter.
        loose = [F.get(parts, F.lit(i)) != "" for i, sign in enumerate(fixed) if sign == "*"]
        if word.endswith(">"):
            loose.append(~F.array_contains(F.slice(parts, len(fixed) + 1, F.greatest(F.size(parts), F.lit(1))), ""))
        depth_ok = reduce(lambda a, b: a & b, loose, depth_ok)
        chosen = [F.get(parts, F.lit(i)) for i, sign in enumerate(fixed) if sign == "="]
        joined = F.concat_ws(".", *chosen) if chosen else F.lit("")
        return F.when(depth_ok, F.struct(F.lit(word).alias("_shape"), joined.alias("_key")))

    def join(chosen: list[str], rows: int) -> DataFrame:
        options = F.array_compact(F.array(*[candidate(s) for s in chosen]))
        exploded = df.withColumn("_candidate", F.explode(options))
        keyed_messages = exploded.select(*df.columns, "_candidate._shape", "_candidate._key")
        wanted = keyed if len(chosen) == len(shapes) else keyed.where(F.col("_shape").isin(chosen))
        return join_small(keyed_messages, wanted, ["_shape", "_key"], rows).drop("_shape", "_key")

    sizes = {r["_shape"]: r["count"] for r in counts}
    parts_of = [p for p in broad_and_narrow(sizes, BROADCAST_ROWS) if p]
    return reduce(DataFrame.union, [join(chosen, sum(sizes[s] for s in chosen)) for chosen in parts_of])


def broad_and_narrow(sizes: dict[str, int], most: int) -> tuple[list[str], list[str]]:
    """Shapes in the order of their fixed tokens: the first ones whose patterns are at most ``most`` rows, and the rest."""
    ordered = sorted(sizes, key=lambda s: (s.count("="), s))
    n, held = 0, 0
    while n < len(ordered) and held + sizes[ordered[n]] <= most:
        held += sizes[ordered[n]]
        n += 1
    return ordered[:n], ordered[n:]


def route_by_token(df: DataFrame, prefix: str, position: int, subject: str = "subject") -> DataFrame:
    """Add the partition stream ``<prefix>-<n>`` named by a numeric subject token; null without one."""
    token = subject_token(F.col(subject), position).try_cast("int")
    return df.withColumn("stream", partition_stream(prefix, token))


def fan_out(df: DataFrame, subjects: Column) -> DataFrame:
    """One copy of each message for every subject in a comma-separated list."""
    names = F.filter(F.transform(F.split(subjects, ","), lambda s: F.trim(s)), lambda s: s != "")
    others = [c for c in df.columns if c != "subject"]
    return df.select(F.explode(names).alias("subject"), *others)


def off_stream(df: DataFrame, patterns: str | list[str], subject: str = "subject") -> DataFrame:
    """Messages whose subject does not belong to a stream with these subjects."""
    return df.where(~F.coalesce(subject_filter(patterns, F.col(subject)), F.lit(False)))


def guard_subjects(df: DataFrame, patterns: str | list[str], stream: str = "stream") -> DataFrame:
    """Pass messages on, but fail the query at the first one that does not belong to the stream."""
    if not parse_patterns(patterns):
        return df
    belongs = F.coalesce(subject_filter(patterns), F.lit(False))
    error = F.raise_error(F.concat(F.lit("subject '"), F.col("subject"), F.lit(f"' is not in stream '{stream}'")))
    return df.withColumn("subject", F.when(belongs, F.col("subject")).otherwise(error.cast("string")))
