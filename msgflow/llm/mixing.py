"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Only DataFrame operations. The driver holds one number, the water level; sources stay a table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgflow.llm.tables import materialize, numbered
from msgflow.session import BROADCAST_ROWS

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)  # by the source's place in code-point order, repeating
SHARE = 1.5  # of all words
EPOCHS = 2  # no source is repeated more often
SEED = "mix"


def word_count(text: Column) -> Column:
    """Words divided by ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw_key(doc_id: Column, seed: str = SEED) -> Column:
    """A document's seeded place in its source, as hexadecimal digits."""
    return F.md5(F.concat(F.lit(seed + "|"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def water_level(sources: DataFrame, budget: float, epochs: float = EPOCHS) -> float:
    """The level at which sources of `size` and `weight`, filled to min(epochs * size, weight * level), hold the budget.

    Each round clamps the sources above their cap and shares what is left by weight; the clamped set only
    grows, and the rounds end when it stays. Infinite if the caps cannot hold the budget.
    """
    cap = F.col("size") * F.lit(float(epochs))
    level, clamped = -1.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > cap
        held, rest, n = sources.agg(
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
            F.coalesce(F.sum(over.cast("long")), F.lit(0)),
        ).first()
        if n == clamped:
            return level
        if not rest:
            return math.inf
        level, clamped = (budget - held) / rest, n


def plan(
    sized: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    epochs: float = EPOCHS,
) -> DataFrame:
    """One row per source of `sized` (source, size, key): source_size, target, whole, cut.

    Every document is taken `whole` times, and once more if its key is at most `cut`. Keys are uniform, so
    only the slice of keys (first four digits) that holds the boundary is ranked: a source with a third of
    all rows is summed map-side by slice, never sorted in one task.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("size"))
    ranked = numbered(totals, [F.col("source").asc_nulls_last()], "mix-sources")
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    sources = materialize(
        ranked.withColumn("weight", F.get(cycle, (F.col("idx") % len(weights)).cast("int"))).drop("idx"), "mix-weights"
    )
    total, count = sources.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    level = water_level(sources, share * total, epochs)
    cap = F.col("size") * F.lit(float(epochs))
    target = cap if math.isinf(level) else F.least(cap, F.col("weight") * F.lit(level))
    sources = sources.withColumn("target", target)
    sources = sources.withColumn(
        "whole", F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(0)
    ).withColumn("need", F.col("target") - F.col("whole") * F.col("size"))

    slices = sized.groupBy("source", F.substring("key", 1, 4).alias("slice")).agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    slices = _with_source(slices.withColumn("end", F.sum("words").over(running)), sources.select("source", "need"), count)
    edge = (F.col("end") > F.col("need")) & (F.col("end") - F.col("words") < F.col("need"))
    found = materialize(
        slices.groupBy("source").agg(
            F.max(F.when(F.col("end") <= F.col("need"), F.concat("slice", F.lit("g")))).alias("full"),
            F.max(F.when(edge, F.struct("slice", (F.col("end") - F.col("words")).alias("start"), "need"))).alias("edge"),
        ),
        "mix-edges",
    )
    edges = found.where("edge is not null").select("source", "edge.*")
    same_slice = F.col("l.slice") == F.col("r.slice")
    inside = _with_source(sized.withColumn("slice", F.substring("key", 1, 4)), edges, count, same_slice)
    inside = inside.groupBy("source", "key", "start", "need").agg(F.sum("size").alias("words"))
    taken = F.sum("words").over(Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    inside = inside.withColumn("middle", F.col("start") + taken - F.col("words") / 2)
    last = inside.where("middle <= need").groupBy("source").agg(F.max("key").alias("key"))
    cuts = _with_source(found, last, count, how="left").select(
        "source",
        # "g" sorts behind every digit: the slices below the boundary are taken whole.
        F.coalesce(F.col("key"), F.col("full"), F.lit("")).alias("cut"),
    )
    plans = _with_source(sources, cuts, count, how="left").select(
        "source", F.col("size").alias("source_size"), "target", F.col("whole").cast("int").alias("whole"),
        F.when(F.col("need") > 0, F.coalesce("cut", F.lit(""))).otherwise("").alias("cut"),
    )
    return materialize(plans, "mix-plans")


def repetitions() -> Column:
    """How often the mix takes a row that has `whole`, `cut` and `key`."""
    return F.col("whole") + (F.col("key") <= F.col("cut")).cast("int")


def mix(documents: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken; columns as given.

    The plan reads source, size and key; texts are read once more and stay where they are, unless the table of
    sources is too large to broadcast. Null texts and sources are texts without words and a source of its own.
    Rows with one doc_id and source share their fate; rows without doc_id are drawn each by itself. Texts of any length count
    with all their words. No rows give no rows.
    """
    options = dict(options)
    keyed = _keyed(documents.select(F.struct("*").alias("row"), "doc_id", "source", "text"), options.pop("seed", SEED))
    plans = plan(_sized(keyed), **options)
    rows = keyed.select(F.col("row").alias("__row"), "source", "key")
    taken = _with_source(rows, plans, plans.count()).withColumn("__times", F.explode(F.array_repeat(F.lit(0), repetitions())))
    return taken.select("__row.*")


def mix_report(documents: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, size, source_size, target (both of its source) and taken, the words the mix takes of it. Special
    cases as in `mix`."""
    options = dict(options)
    sized = _sized(_keyed(documents.select("doc_id", "source", "text"), options.pop("seed", SEED)))
    plans = plan(sized, **options)
    joined = _with_source(sized, plans, plans.count())
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * repetitions()).alias("taken"))


def _keyed(documents: DataFrame, seed: str) -> DataFrame:
    """The rows with their key. Rows without doc_id are numbered in the order of source and text, so that many of them do
    not share one key; which of equal rows has which number makes no difference."""
    own = documents.withColumn("key", draw_key(F.col("doc_id"), seed))
    lost = documents.where("doc_id is null")
    if lost.isEmpty():
        return own
    digest = F.md5(F.coalesce(F.col("text"), F.lit("")))
    placed = numbered(lost.withColumn("digest", digest), [F.col("source"), F.col("digest"), F.col("text")], "mix-lost", "number")
    placed = placed.withColumn("key", draw_key(F.concat(F.lit("null|"), F.col("number").cast("string")), seed))
    return own.where("doc_id is not null").unionByName(placed.select(own.columns))


def _sized(keyed: DataFrame) -> DataFrame:
    return materialize(keyed.select("doc_id", "source", word_count(F.col("text")).alias("size"), "key"), "mix-sizes")


def _with_source(
    left: DataFrame, right: DataFrame, rows: int, also: Column | None = None, how: str = "inner"
) -> DataFrame:
    """Join on source, null with null, with a side of at most `rows` rows: broadcast up to a bound, so that a source with
    very many documents stays where it lies; above it a large source is split by adaptive execution."""
    if rows <= BROADCAST_ROWS:
        right = F.broadcast(right)
    on = F.col("l.source").eqNullSafe(F.col("r.source"))
    joined = left.alias("l").join(right.alias("r"), on if also is None else on & also, how)
    extra = [F.col(f"r.{c}") for c in right.columns if c not in left.columns]
    return joined.select("l.*", *extra)
