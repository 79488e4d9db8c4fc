"""Benchmark decontamination by spaced seeds: find benchmark passages in documents although words were exchanged.

Only DataFrame operations. A seed is a mask over neighbouring tokens that ignores some of them. Test and training
texts are hashed under the same masks, the hashes are joined, and each hit is verified token by token around it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow.llm.tables import materialize
from msgflow.session import join_small

SIMILARITY = 0.8
REGION = 13  # tokens compared around a hit, or the whole item if it is shorter
SHORTEST = 8  # tokens of an item that is evidence
SEED_ROWS = 200_000  # seeds that are broadcast at once; more are joined in rounds
PIECE = 250  # places of a document that are hashed at once


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits; null has none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def masks(n: int, similarity: float = SIMILARITY) -> tuple[str, ...]:
    """Masks of which one shows equal tokens only, wherever a window of n tokens is similar enough.

    With k tokens exchanged at most, two of k + 2 blocks of the window stay whole. A mask shows two blocks, and there
    is one for each distance they can have.
    """
    exchanged = max(k for k in range(n) if k == 0 or (n - k) / n >= similarity)
    block = n // (exchanged + 2)
    if not block:
        return ("1",)
    return tuple("1" * block + "0" * (gap * block) + "1" * block for gap in range(exchanged + 1))


def _codes(name: str) -> Column:
    """Tokens as numbers, so that a token is hashed once and not under each mask that shows it."""
    return F.transform(name, lambda token: F.xxhash64(token))


def _pieces(df: DataFrame, region: int) -> DataFrame:
    """Documents (doc_id, tokens) in pieces of PIECE places, begin to end, with `region` tokens on both sides of them.

    A piece is a text of its own, whose first token is the one at `offset`. The higher-order function in the generator
    keeps Spark from compiling it together with what follows, which would collect all that comes of a row before
    passing on any of it: so that holds for a piece, not for a document.
    """

    def piece(start: Column) -> Column:
        offset = F.greatest(start - region, F.lit(0))
        begin = start - offset
        parts = [F.slice(name, offset + 1, begin + PIECE + region).alias(name) for name in ("tokens", "codes")]
        end = F.least(begin + PIECE, F.size("tokens") - offset) - 1
        return F.struct(offset.alias("offset"), begin.alias("begin"), F.greatest(begin, end).alias("end"), *parts)

    starts = F.sequence(F.lit(0), F.greatest(F.size("tokens") - 1, F.lit(0)), F.lit(PIECE))
    coded = df.withColumn("codes", _codes("tokens"))
    return coded.select("doc_id", F.explode(F.transform(starts, piece)).alias("piece")).select("doc_id", "piece.*")


def _seeds(df: DataFrame, place: str, shapes: tuple[str, ...]) -> DataFrame:
    """A row for every place from begin to end and mask that fits, with the hash of the mask and the codes it shows, and its span."""
    placed = df.withColumn(place, F.explode(F.sequence(F.col("begin"), F.col("end")))).drop("begin", "end")
    hashes = []
    for mask in shapes:
        shown = [F.get("codes", F.col(place) + k) for k, bit in enumerate(mask) if bit == "1"]
        fits = F.col(place) + len(mask) <= F.size("codes")
        hashes.append(F.when(fits, F.xxhash64(F.lit(mask), *shown)))
    spans = F.array(*[F.lit(len(mask)) for mask in shapes])
    seeds = placed.select("*", F.posexplode(F.array(*hashes)).alias("mask", "seed")).where("seed is not null")
    return seeds.withColumn("span", F.get(spans, F.col("mask"))).drop("mask", "codes")


def _hits(read: DataFrame, seeds: DataFrame, region: int) -> DataFrame:
    """Places of documents whose seed some item has, with the `region` tokens before and from the place as a text of its own."""
    known = read.join(F.broadcast(seeds.select("seed")), "seed", "left_semi")
    start = F.greatest(F.col("place") - region, F.lit(0))
    end = F.least(F.col("place") + region, F.size("tokens"))
    # Not compiled either: the items of a seed are joined for one hit at a time.
    around = F.transform(F.sequence(start, end - 1), lambda k: F.get("tokens", k))
    return known.select(
        "doc_id",
        "seed",
        (F.col("offset") + start).alias("offset"),
        (F.col("place") - start).alias("place"),
        around.alias("tokens"),
    )


def leaks(
    documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, region: int = REGION
) -> DataFrame:
    """Contaminated documents: per document and item doc_id, item_id, n_hits (verified), overlap (the best share of equal
    tokens) and the tokens they span, doc_start and doc_end, item_start and item_end (ends excluded).

    A hit aligns a document with an item. It is verified in every window of `region` aligned tokens that holds the seed
    (the whole item if it is shorter): the share of equal tokens must be `similarity` or more in one. The masks follow
    from an item's window, so every window that is similar enough is hit: what is found is exactly what a comparison of
    all alignments finds.

    Items shorter than SHORTEST tokens are no evidence and match nothing, like null and empty texts.
    Rows with one doc_id are reported as one document, repeated items under their smallest item_id; items without an id are
    left out. Tables without rows give no rows.

    Documents are read once per round of at most SEED_ROWS benchmark seeds, and never shuffled: each round broadcasts its
    seeds and items, verifies hits where they arise, and shuffles what has been verified, summed by document and item.
    A hit carries the tokens around it, not its document, so memory grows with a document's length, not with its square.
    """
    items = benchmark.where("item_id is not null").groupBy(tokens(F.col("text")).alias("item_tokens"))
    items = items.agg(F.min("item_id").alias("item_id")).withColumn("item", F.xxhash64("item_tokens"))
    items = materialize(items, "leak-items")
    window = F.least(F.lit(region), F.size("item_tokens"))
    lengths = [r[0] for r in items.where(F.size("item_tokens") >= SHORTEST).select(window).distinct().collect()]
    # The lengths of windows that share their masks; documents are hashed under the masks that some item needs.
    by_masks: dict[tuple[str, ...], list[int]] = {}
    for n in sorted(lengths, reverse=True):
        by_masks.setdefault(masks(n, similarity), []).append(n)
    shapes = tuple(dict.fromkeys(mask for group in by_masks for mask in group)) or masks(region, similarity)
    each = [items.where("false").select(F.lit(0).cast("long").alias("seed"), "item", F.lit(0).alias("item_place"), F.lit(0).alias("span"))]
    for group, own_lengths in by_masks.items():
        long_enough = items.where((F.size("item_tokens") >= SHORTEST) & window.isin(own_lengths))
        whole = long_enough.select("item", _codes("item_tokens").alias("codes"), F.lit(0).alias("begin"), (F.size("item_tokens") - 1).alias("end"))
        each.append(_seeds(whole, "item_place", group).select(*each[0].columns))
    seeds = materialize(reduce(DataFrame.union, each), "leak-seeds")
    rounds = max(1, -(-seeds.count() // SEED_ROWS))
    texts = documents.select("doc_id", tokens(F.col("text")).alias("tokens"))
    read = _seeds(_pieces(texts, region), "place", shapes).drop("span")
    own = F.pmod(F.col("item"), F.lit(rounds))
    found = []
    for k in range(rounds):
        own_seeds = seeds.where(own == k)
        hits = _hits(read, own_seeds, region).join(F.broadcast(own_seeds), "seed")
        found.append(_verified(hits.join(F.broadcast(items.where(own == k)), "item"), similarity, region))
    return reduce(DataFrame.union, found).groupBy("doc_id", "item_id").agg(
        F.count("*").alias("n_hits"),
        F.max("overlap").alias("overlap"),
        F.min("doc_start").alias("doc_start"),
        F.max("doc_end").alias("doc_end"),
        F.min("item_start").alias("item_start"),
        F.max("item_end").alias("item_end"),
    )


def _verified(hits: DataFrame, similarity: float, region: int) -> DataFrame:
    ahead = F.col("place") - F.col("item_place")  # where the item would begin in the document
    n = F.least(F.lit(region), F.size("item_tokens"))
    low = F.greatest(F.lit(0), -ahead, F.col("item_place") + F.col("span") - n)
    high = F.least(F.size("item_tokens") - n, F.size("tokens") - ahead - n, F.col("item_place"))
    placed = hits.withColumns({"n": n, "ahead": ahead, "low": low, "windows": high - low + 1}).where("windows > 0")
    # Equal tokens of each window; the array of one element keeps the comparison of tokens from being repeated.
    equal = F.expr(
        """transform(array(zip_with(slice(tokens, greatest(ahead + low, 0) + 1, greatest(windows + n - 1, 0)),
             slice(item_tokens, low + 1, greatest(windows + n - 1, 0)), (a, b) -> if(a = b, 1, 0))),
             same -> transform(sequence(1, greatest(windows, 1)),
               w -> aggregate(slice(same, w, n), 0, (total, x) -> total + x)))[0]"""
    )
    similar = placed.withColumn("equal", equal).withColumn("overlap", F.array_max("equal") / F.col("n"))
    similar = similar.where(F.col("overlap") >= similarity).withColumn(
        "passes", F.transform("equal", lambda x: x / F.col("n") >= similarity)
    )
    first = F.col("low") + F.array_position("passes", F.lit(True)).cast("int") - 1
    end = F.col("low") + F.col("windows") - F.array_position(F.reverse("passes"), F.lit(True)).cast("int") + F.col("n")
    ends = similar.withColumns({"item_start": first, "item_end": end})
    return ends.select(
        "doc_id",
        "item_id",
        "overlap",
        (F.col("offset") + F.col("ahead") + F.col("item_start")).alias("doc_start"),
        (F.col("offset") + F.col("ahead") + F.col("item_end")).alias("doc_end"),
        "item_start",
        "item_end",
    )


def drop_leaks(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without benchmark passages; columns as given. All rows of a contaminated doc_id go (also null)."""
    found = materialize(
        leaks(documents, benchmark, **options).select(F.col("doc_id").alias("__leaked")).distinct(), "leak-documents"
    )
    marked = found.select(F.struct("__leaked").alias("__leak"))
    rows = documents.select(F.struct("*").alias("__row"), F.struct(F.col("doc_id").alias("__leaked")).alias("__leak"))
    # A struct is never null, so documents without a doc_id are joined as well.
    return join_small(rows, marked, ["__leak"], found.count(), "left_anti").select("__row.*")
