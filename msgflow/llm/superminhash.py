"""Near-duplicate documents by SuperMinHash signatures, banding, exact verification and union-find.

1. Each document's set of word shingles gets a signature: every element deals out its ranks by its own random
   permutation, rank by rank, until no signature place can fall any more.
2. Documents with the same set are one class. Classes that share a band are candidates; candidates connected
   through bands form a cluster. Stars around each band's smallest document connect them without listing pairs.
3. Clusters are verified on full sets in tiles of bounded size. A large cluster is cut by set size (linked sets
   differ by less than the similarity) and by a hash; only tiles that can hold links meet. A tile gives a
   spanning forest of its links, not the links.
4. Connected components of the forests are the groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgflow.llm import words as W
from msgflow.llm.tables import connected_components, materialize
from msgflow.session import ship_package

SHINGLE = 5
BANDS = 30
ROWS = 5
SIMILARITY = 80  # per cent; 85 where the contract says so
TILE_DOCUMENTS = 512
TILE_SHINGLES = 200_000


def signatures(values: np.ndarray, owners: np.ndarray, size: int, places: int) -> np.ndarray:
    """SuperMinHash signatures, one row per owner; owners without values keep infinity.

    At rank k every element still in play puts k plus a random fraction on the k-th place of its own permutation
    (Fisher-Yates, one step per rank), and each place keeps the least. Later ranks are larger, so an owner whose
    places are all taken is done: long documents end after a few ranks.
    """
    out = np.full(size * places, np.inf)
    permutation = np.tile(np.arange(places, dtype=np.uint16), (len(values), 1))
    rows, owner = np.arange(len(values)), owners
    for k in range(places):
        if not len(rows):
            break
        random = W.mix64(values[rows] + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        step = k + (((random >> np.uint64(32)) * np.uint64(places - k)) >> np.uint64(32)).astype(np.int64)
        fraction = (random & np.uint64((1 << 53) - 1)).astype(np.float64) / (1 << 53)
        place = permutation[rows, step]
        permutation[rows, step] = permutation[rows, k]
        np.minimum.at(out, owner * places + place, k + fraction)
        done = np.isfinite(out.reshape(size, places)).all(axis=1)
        playing = ~done[owner]
        rows, owner = rows[playing], owner[playing]
    return out.reshape(size, places)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band of each signature."""
    bits = signature.view(np.uint64).reshape(len(signature), bands, rows)
    key = np.broadcast_to(W.mix64(np.arange(1, bands + 1, dtype=np.uint64)), bits.shape[:2]).copy()
    for k in range(rows):
        key = W.mix64(key * np.uint64(3) + bits[:, :, k])
    return key


def _sets(texts: pa.Array, hasher: W.Hasher, shingle: int) -> Iterator[tuple[W.Slice, np.ndarray, np.ndarray]]:
    for part in W.slices(texts, W.SPACE, lower=True):
        yield part, *W.distinct(*W.shingles(part, hasher.words(part), shingle))


def sign(documents: DataFrame, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per document: doc_id, n_shingles, a 128-bit key of its set (key1, key2) and its band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = W.Hasher()
        for batch in batches:
            for part, values, owners in _sets(batch["text"], hasher, shingle):
                n = np.bincount(owners, minlength=part.size)
                ends = np.concatenate([[0], np.cumsum(n)])
                keys = []
                for salt in (1, 2):
                    total = np.zeros(len(values) + 1, np.uint64)
                    np.cumsum(W.mix64(values ^ np.uint64(salt)), out=total[1:], dtype=np.uint64)
                    keys.append((total[ends[1:]] - total[ends[:-1]]).view(np.int64))
                found = np.flatnonzero(n)
                signature = signatures(values, owners, part.size, bands * rows)[found]
                band = band_keys(signature, bands, rows).view(np.int64).ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(part.row, part.size),
                        pa.array(n, pa.int64()),
                        pa.array(keys[0]),
                        pa.array(keys[1]),
                        W.lists(band, np.repeat(found, bands), part.size, pa.int64()),
                    ],
                    ["doc_id", "n_shingles", "key1", "key2", "bands"],
                )

    return documents.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_shingles long, key1 long, key2 long, bands array<long>"
    )


def near_duplicates(documents: DataFrame, similarity: int = SIMILARITY, **options) -> DataFrame:
    """Per row of documents: doc_id, n_shingles, component_id, kept.

    Two documents are linked if 100 * common shingles >= similarity * all shingles of both. component_id is the
    smallest doc_id reached over links, and the row of that doc_id is kept. Texts without words (or null) have no
    shingles and are linked with nothing. Rows with one doc_id are one document and get one component. Rows without a doc_id are not
    grouped: their component is null and they are kept. No rows give no rows.
    """
    ship_package()
    signed = materialize(sign(documents, **options), "near-signatures")
    usable = signed.where("n_shingles > 0 and doc_id is not null")
    same = ["key1", "key2", "n_shingles"]
    classes = materialize(usable.groupBy(*same).agg(F.min("doc_id").alias("rep")), "near-classes")

    first = [F.col(f"s.{c}") == F.col(f"c.{c}") for c in same]
    reps = usable.alias("s").join(classes.alias("c"), [*first, F.col("s.doc_id") == F.col("c.rep")])
    banded = reps.select("c.rep", F.explode("s.bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("rep").alias("low"), F.count("*").alias("n")).where("n > 1")
    stars = banded.join(buckets, "band").where("rep != low").select(F.col("rep").alias("a"), F.col("low").alias("b"))
    clusters = connected_components(stars.distinct(), "near-clusters")

    sized = classes.groupBy("rep").agg(F.max("n_shingles").alias("n"))  # of two texts with one id, the longer
    members = clusters.join(sized, clusters["node"] == sized["rep"]).select("rep", F.col("component").alias("cluster"), "n")
    tiles = materialize(_tiles(materialize(members, "near-members"), similarity), "near-tiles")
    forest = _verify(documents, tiles, similarity, options.get("shingle", SHINGLE))
    groups = connected_components(forest, "near-groups")

    named = classes.join(groups, classes["rep"] == groups["node"], "left").select(
        *same, F.coalesce("component", "rep").alias("component_id")
    )
    # A class without words is each document for itself.
    found = signed.alias("s").join(named.alias("c"), first, "left").select("s.doc_id", "s.n_shingles", "c.component_id")
    alone = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id"))
    return found.select("doc_id", "n_shingles", F.coalesce(alone, "doc_id").alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def drop_near_duplicates(documents: DataFrame, similarity: int = SIMILARITY, **options) -> DataFrame:
    """The documents kept: one row for each kept doc_id, and all rows without one; columns as given."""
    kept = near_duplicates(documents, similarity, **options).where("kept and doc_id is not null")
    kept = kept.select(F.col("doc_id").alias("__kept")).distinct()
    named = documents.join(kept, documents["doc_id"] == kept["__kept"], "left_semi").dropDuplicates(["doc_id"])
    return named.union(documents.where(documents["doc_id"].isNull()))


def _tiles(members: DataFrame, similarity: int) -> DataFrame:
    """(rep, tiles): the tiles in which a document of a cluster meets others, with its side in each.

    A small cluster is one tile. A larger one is cut into blocks by class of set size and a hash. Linked sets
    lie in the same or in neighbouring classes, so only their blocks are paired.
    """
    # A little wider than the ratio of linked sets, so rounding can't part them by two classes.
    width = math.log(1 / (similarity / 100 - 0.001))
    total = members.groupBy("cluster").agg(F.sum("n").alias("shingles"), F.count("*").alias("documents"))
    members = members.join(total, "cluster")
    small = (F.col("shingles") <= TILE_SHINGLES) & (F.col("documents") <= TILE_DOCUMENTS)
    members = members.withColumn("class", F.when(small, -1).otherwise(F.floor(F.log("n") / width)).cast("int"))
    cuts = members.groupBy("cluster", "class").agg(
        F.ceil(F.greatest(F.sum("n") / TILE_SHINGLES, F.count("*") / TILE_DOCUMENTS)).cast("int").alias("cuts")
    )
    cuts = cuts.withColumn("cuts", F.when(F.col("class") < 0, 1).otherwise(F.col("cuts")))
    blocks = cuts.alias("c")
    for side, step in (("above", 1), ("below", -1)):
        near = cuts.select("cluster", (F.col("class") - step).alias("class"), F.col("cuts").alias(side))
        blocks = blocks.join(near.where("class >= 0"), ["cluster", "class"], "left")
    blocks = blocks.na.fill(0, ["above", "below"])
    placed = members.join(blocks, ["cluster", "class"]).withColumn(
        "block", F.pmod(F.xxhash64("rep"), F.col("cuts")).cast("int")
    )
    return placed.select(
        "rep",
        F.expr(
            """
            concat(
              transform(sequence(0, cuts - 1), j -> struct(
                xxhash64(cluster, class, least(block, j), class, greatest(block, j)) as tile,
                if(j < block, 1, 0) as side, j = block as whole)),
              if(above > 0, transform(sequence(0, above - 1), j -> struct(
                xxhash64(cluster, class, block, class + 1, j) as tile, 0 as side, false as whole)), array()),
              if(below > 0, transform(sequence(0, below - 1), j -> struct(
                xxhash64(cluster, class - 1, j, class, block) as tile, 1 as side, false as whole)), array()))
            """
        ).alias("tiles"),
    )


def _verify(documents: DataFrame, tiles: DataFrame, similarity: int, shingle: int) -> DataFrame:
    """Forest edges (a, b) of the links, from full sets."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = W.Hasher()
        for batch in batches:
            for part, values, owners in _sets(batch["text"], hasher, shingle):
                sets = W.lists(values.view(np.int64), owners, part.size, pa.int64())
                tiles = batch["tiles"].slice(part.row, part.size)
                row = pa.array(np.repeat(np.arange(part.size), pc.list_value_length(tiles).to_numpy()))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(tiles.flatten().field(k) for k in range(3)),
                        batch["rep"].slice(part.row, part.size).take(row),
                        sets.take(row),
                    ],
                    ["tile", "side", "whole", "rep", "shingles"],
                )

    def link(tile: pa.Table) -> pa.Table:
        a, b = forest_of(
            [x.values.to_numpy() for x in tile["shingles"]], tile["side"].to_numpy(), tile["whole"][0].as_py(),
            tile["rep"].to_numpy(), similarity,
        )
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    # Texts are shuffled once at every size; which tiles exist says little about how many documents they name.
    texts = documents.select("doc_id", "text").join(tiles.hint("merge"), F.col("doc_id") == F.col("rep"))
    dealt = texts.select("text", "rep", "tiles").mapInArrow(
        deal, "tile long, side int, whole boolean, rep long, shingles array<long>"
    )
    return dealt.groupBy("tile").applyInArrow(link, "a long, b long")


def forest_of(
    sets: list[np.ndarray], side: np.ndarray, whole: bool, names: np.ndarray, similarity: int, columns: int = 4096
) -> tuple[np.ndarray, np.ndarray]:
    """Links inside a tile (whole) or between its two sides, as edges to the smallest name of each part."""
    sizes = np.array([len(x) for x in sets])
    owners = np.repeat(np.arange(len(sets)), sizes)
    _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1  # a shingle of one document is in no intersection
    number = np.cumsum(shared) - 1
    keep = shared[token]
    owners, token = owners[keep], number[token[keep]]
    order = np.argsort(token, kind="stable")
    owners, token = owners[order], token[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(shared.sum()), columns):
        own = slice(np.searchsorted(token, low), np.searchsorted(token, low + columns))
        held = np.zeros((len(sets), min(columns, int(shared.sum()) - low)), np.float32)
        held[owners[own], token[own] - low] = 1
        common += held @ held.T
    linked = 100 * common.astype(np.int64) >= similarity * (sizes[:, None] + sizes[None, :] - common.astype(np.int64))
    linked &= common > 0
    if not whole:
        linked &= side[:, None] != side[None, :]
    linked |= names[:, None] == names[None, :]
    a, b, left = [], [], np.ones(len(sets), bool)
    for start in range(len(sets)):
        if left[start]:
            part = np.zeros(len(sets), bool)
            edge = part.copy()
            edge[start] = True
            while edge.any():
                part |= edge
                edge = linked[edge].any(axis=0) & ~part
            left &= ~part
            if part.sum() > 1:
                a.append(names[part])
                b.append(np.full(part.sum(), names[part].min()))
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64), np.zeros(0, np.int64))
