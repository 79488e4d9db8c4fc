"""SimHash fingerprints of 64 bits and the search for all fingerprints within a Hamming radius.

Only DataFrame operations. Terms are lower-case words. A term's weight grows with its rarity: words are counted over
all documents in 65,536 hash slots, so the table of weights has a proven size and is the only side broadcast.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow.llm.tables import materialize, numbered

BITS = 64
REPEATS = 65_536  # rows that one step of repeating a row makes
SLOTS = 1 << 16
BLOCKS = (11, 11, 11, 11, 10, 10)  # bits of each block of a fingerprint
RADIUS = 3
SPACES = r"[\x20\x09-\x0D]+"


def _terms(text: Column) -> Column:
    return F.split(F.lower(text), SPACES)


def term_weights(documents: DataFrame) -> DataFrame:
    """(slot, weight): at most 65,536 rows. The weight is the squared binary logarithm of one over the frequency."""
    words = documents.select(F.explode(_terms(F.col("text"))).alias("term")).where("term != ''")
    counts = materialize(words.groupBy(_slot(F.xxhash64("term")).alias("slot")).agg(F.count("*").alias("n")), "sim-slots")
    total = counts.agg(F.sum("n")).first()[0] or 1
    return counts.select("slot", _weight(F.col("n"), total).alias("weight")), _weight(F.lit(1), total)


def _slot(hash: Column) -> Column:
    return F.pmod(hash, F.lit(SLOTS)).cast("int")


def _weight(n: Column, total: int) -> Column:
    return (F.floor(F.pow(F.log2(F.lit(float(total)) / n), 2)) + 1).cast("long")


def votes(texts: DataFrame, weights: DataFrame, rarest: Column) -> DataFrame:
    """The rows' distinct other columns with the fingerprint of their `text`: terms vote on bits with +/- weight.

    Terms are summed map-side, so only one row per text and task is shuffled. Rows alike in all other columns must
    have one text. A text without words has the fingerprint 0.
    """
    keys = [c for c in texts.columns if c != "text"]
    words = texts.select(*keys, F.explode(_terms(F.col("text"))).alias("term"))
    hashed = words.select(*keys, (F.col("term") != "").alias("real"), F.xxhash64("term").alias("h"))
    weighed = hashed.withColumn("slot", _slot(F.col("h"))).join(F.broadcast(weights), "slot", "left")
    weight = F.when(F.col("real"), F.coalesce("weight", rarest)).otherwise(F.lit(0)).cast("long")
    weighed = weighed.select(*keys, "h", weight.alias("w"))
    sums = [
        F.sum((F.shiftrightunsigned("h", i).bitwiseAND(F.lit(1)) * 2 - 1) * F.col("w")).alias(f"b{i}") for i in range(BITS)
    ]
    bits = [F.when(F.col(f"b{i}") > 0, F.shiftleft(F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")) for i in range(BITS)]
    while len(bits) > 1:
        bits = [a.bitwiseOR(b) for a, b in zip(bits[::2], bits[1::2])]
    return weighed.groupBy(*keys).agg(*sums).select(*keys, bits[0].alias("fingerprint"))


def fingerprints(documents: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fingerprint) of every distinct document; null texts are empty."""
    texts = documents.select("doc_id", *_text_columns())
    return votes(texts, *term_weights(texts))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / BITS


def within_radius(queries: DataFrame, index: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(query, found, distance) for all pairs of a fingerprint of `queries` and one of `index` (column fingerprint)
    that differ in at most `radius` bits. Exact.

    With radius + 3 blocks, of which at most `radius` differ, three blocks at least are equal: each table puts one choice of
    three blocks in front, as the key of an equi-join. A pair is given by the first table that has it, so none comes
    twice. Equal fingerprints are joined once, whatever the number of documents.
    """
    if radius > len(BLOCKS) - 3:
        raise ValueError(f"radius must be at most {len(BLOCKS) - 3}")
    masks, low = [], 0
    for width in BLOCKS:
        masks.append(((1 << width) - 1) << low)
        low += width
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    tables = list(combinations(range(len(BLOCKS)), 3))

    def keyed(df: DataFrame, name: str) -> DataFrame:
        choices = F.array(*[
            F.struct(F.lit(t).alias("table"), F.col("fingerprint").bitwiseAND(F.lit(sum(signed[b] for b in blocks))).alias("key"))
            for t, blocks in enumerate(tables)
        ])
        rows = df.select("fingerprint").distinct()
        return rows.select(F.col("fingerprint").alias(name), F.explode(choices).alias("x")).select(name, "x.*")

    differ = F.col("query").bitwiseXOR(F.col("found"))
    first = F.lit(False)
    for t, blocks in enumerate(tables):
        # The first table of a pair holds its three lowest equal blocks.
        passed = [b for b in range(max(blocks)) if b not in blocks]
        lowest = F.lit(True)
        for b in passed:
            lowest &= differ.bitwiseAND(F.lit(signed[b])) != 0
        first |= (F.col("q.table") == t) & lowest
    distance = F.bit_count(differ)
    return (
        keyed(queries, "query").alias("q")
        .join(
            # Each fingerprint becomes a row per table: a side that looked small before must not be broadcast after that.
            keyed(index, "found").alias("i").hint("merge"),
            (F.col("q.table") == F.col("i.table")) & (F.col("q.key") == F.col("i.key")) & first & (distance <= radius),
        )
        .select("query", "found", distance.alias("distance"))
    )


def _text_columns() -> list[Column]:
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.xxhash64(text).alias("text_hash"), text.alias("text")]


def edit_report(documents: DataFrame, radius: int = RADIUS, query_step: int = 50) -> DataFrame:
    """Per row of documents: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next and, for every doc_id divisible by `query_step`, near_documents: how many other documents have a
    fingerprint within the radius (null for the rest).

    The edited text has the last floor(n_chars / 4) code points replaced by the first as many (or all) of the next document by
    doc_id, after the last the first; documents of one doc_id follow each other by a hash of their texts, a null
    doc_id comes first. Only that many characters of the next document are shuffled to its predecessor. Repeated
    rows are one document in this order, and every one of them gets its row. No rows give no rows.
    """
    texts = documents.select("doc_id", *_text_columns())
    weights, rarest = term_weights(texts)
    key = ["doc_id", "text_hash"]
    order = numbered(
        texts.groupBy(*key, F.length("text").cast("long").alias("n_chars")).agg(F.count("*").alias("times")),
        [F.col(c) for c in key],
        "sim-order",
    )
    order = materialize(order, "sim-numbers")
    n = order.count()
    after = order.select(*[F.col(c).alias(f"next_{c}") for c in key], F.pmod(F.col("idx") - 1, F.lit(max(n, 1))).alias("idx"))
    pairs = materialize(order.join(after, "idx").drop("idx"), "sim-pairs")

    def on(left: list[str], right: list[str]) -> Column:
        return F.col(f"l.{left[0]}").eqNullSafe(F.col(f"r.{right[0]}")) & (F.col(f"l.{left[1]}") == F.col(f"r.{right[1]}"))

    following = [f"next_{c}" for c in key]
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    heads = texts.alias("l").join(pairs.alias("r"), on(key, following)).select(
        *[F.col(f"r.{c}") for c in key], "n_chars", F.expr("substring(text, 1, cast(floor(n_chars / 4) as int))").alias("head")
    )
    heads = heads.groupBy(*key, "n_chars").agg(F.first("head").alias("head"))  # equal rows have equal heads
    kept = F.expr("substring(text, 1, cast(n_chars - floor(n_chars / 4) as int))")
    edited = texts.alias("l").join(heads.alias("r"), on(key, key)).select(
        *[F.col(f"l.{c}") for c in key], "n_chars", "text", F.concat(kept, F.col("head")).alias("edited")
    )
    both = edited.withColumn("edited_sha256", F.sha2("edited", 256)).select(
        *key, "n_chars", "edited_sha256",
        F.explode(F.array(F.struct(F.lit(0).alias("side"), "text"), F.struct(F.lit(1).alias("side"), F.col("edited").alias("text")))).alias("x"),
    )
    voted = votes(both.select(*key, "n_chars", "edited_sha256", "x.side", "x.text"), weights, rarest)
    prints = materialize(
        voted.groupBy(*key, "n_chars", "edited_sha256").agg(
            F.max(F.when(F.col("side") == 0, F.col("fingerprint"))).alias("fingerprint"),
            F.max(F.when(F.col("side") == 1, F.col("fingerprint"))).alias("edited_fingerprint"),
        ),
        "sim-prints",
    )
    followed = prints.alias("l").join(pairs.select(*key, *following, "times").alias("r"), on(key, key)).select(
        "l.*", "r.times", *[f"r.{c}" for c in following]
    )
    followers = prints.select(*key, F.col("fingerprint").alias("next_fingerprint"))
    joined = followed.alias("l").join(followers.alias("r"), on(following, key)).select("l.*", "r.next_fingerprint")

    asked = prints.where(F.col("doc_id") % query_step == 0)
    copies = prints.groupBy("fingerprint").agg(F.count("*").alias("copies"))
    near = within_radius(asked, prints, radius).join(copies, F.col("found") == F.col("fingerprint"))
    near = near.groupBy(F.col("query").alias("fingerprint")).agg((F.sum("copies") - 1).alias("near_documents"))
    result = joined.join(near, "fingerprint", "left")
    # A row for each repeat, in steps: a document may hold any share of the rows.
    step = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / REPEATS)))
    result = result.withColumn("step", step)
    left = F.least(F.lit(REPEATS).cast("long"), F.col("times") - F.col("step") * REPEATS).cast("int")
    result = result.withColumn("repeat", F.explode(F.array_repeat(F.lit(0), left)))
    return result.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        _hex(F.col("fingerprint")).alias("fingerprint"),
        _hex(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
        F.when(F.col("doc_id") % query_step == 0, F.col("near_documents")).alias("near_documents"),
    )


def _hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))
