"""Substring deduplication: words covered by a window of words that also starts earlier in the corpus.

1. Every window names its anchor, the least hash among its runs of GRAM words. Equal windows have equal anchors, so a
   window can recur only if its anchor does. Anchors (about one in seven words) are counted over all documents.
2. Documents with recurring anchors are cut into slices. Each slice compiles the recurring phrases that its documents
   hold into an Aho-Corasick automaton over word symbols, streams its documents through it, and takes the windows
   around every occurrence.
3. Those windows are confirmed by their own hashes: a window goes if a smaller doc_id has it, too, or the same document
   before. Copies of whole documents are found by a hash of all words and need no windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow.llm import words as W
from msgflow.llm.tables import materialize
from msgflow.session import ship_package

WINDOW = 20
GRAM = 8
# Where a doc_id is missing, the document comes after all others.
_LAST = (1 << 63) - 1
_EMPTY = hashlib.sha256(b"").hexdigest()


def anchors(part: W.Slice, hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Anchor hashes of all windows and the documents that own them: each once per document, or twice if it is an anchor
    at several places of the document."""
    places, owners = W.run_places(part, window)
    if not len(places):
        return np.zeros(0, np.uint64), owners
    grams = W.runs(hashes, gram)
    n = len(hashes) - window + 1
    best, at = grams[:n].copy(), np.zeros(n, np.int64)
    for k in range(1, window - gram + 1):
        less = grams[k : k + n] < best  # the leftmost of equal ones stays
        best[less] = grams[k : k + n][less]
        at[less] = k
    chosen = places + at[places]
    new = np.ones(len(chosen), bool)
    new[1:] = chosen[1:] != chosen[:-1]
    values, owners = grams[chosen[new]], owners[new]
    order = np.argsort(values, kind="stable")
    order = order[np.argsort(owners[order], kind="stable")]
    values, owners = values[order], owners[order]
    third = np.zeros(len(values), bool)
    third[2:] = (values[2:] == values[:-2]) & (owners[2:] == owners[:-2])
    return values[~third], owners[~third]


def sequence_keys(part: W.Slice, hashes: np.ndarray, hasher: W.Hasher) -> list[np.ndarray]:
    """Two 64-bit hashes of each document's whole word sequence."""
    hasher.grow(len(hashes) + 1)
    keys = []
    for salt in (1, 2):
        total = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(W.mix64(hashes + np.uint64(salt)) * hasher.powers[: len(hashes)], out=total[1:], dtype=np.uint64)
        low, high = part.first[:-1], part.first[1:]
        keys.append(W.mix64((total[high] - total[low]) * hasher.inverses[low]).view(np.int64))
    return keys


def _raw_words(part: W.Slice, d: int) -> list[bytes]:
    return part.data[part.offsets[d] : part.offsets[d + 1]].tobytes().split()


def _read(documents: DataFrame, window: int) -> DataFrame:
    """Per row: doc_id, place (its order), n_words, key1, key2, sha256 of all words, anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = W.Hasher()
        for batch in batches:
            for part in W.slices(batch["text"]):
                hashes = hasher.words(part)
                found, owners = anchors(part, hashes, window)
                digests = [hashlib.sha256(b" ".join(_raw_words(part, d))).hexdigest() for d in range(part.size)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(part.row, part.size),
                        pa.array(part.counts(), pa.int64()),
                        *map(pa.array, sequence_keys(part, hashes, hasher)),
                        pa.array(digests),
                        W.lists(found.view(np.int64), owners, part.size, pa.int64()),
                    ],
                    ["doc_id", "n_words", "key1", "key2", "sha256", "anchors"],
                )

    schema = "doc_id long, n_words long, key1 long, key2 long, sha256 string, anchors array<long>"
    return documents.select("doc_id", "text").mapInArrow(run, schema).withColumn("place", _place(F.col("doc_id")))


def _place(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(_LAST))


def _automaton(symbols: np.ndarray, starts: np.ndarray, gram: int) -> ahocorasick.Automaton:
    """Automaton of the phrases of `gram` symbols that begin at the starts."""
    machine = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for start in starts.tolist():
        machine.add_word(tuple(symbols[start : start + gram].tolist()), 1)
    machine.make_automaton()
    return machine


def occurrences(part: W.Slice, hashes: np.ndarray, recurring: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """First words of every occurrence of a phrase whose hash is among the recurring ones.

    The slice's automaton holds each phrase once; it reports every occurrence in a single pass over the words. A few more
    may be reported where 31-bit symbols of words are equal; windows are confirmed by their own hashes.
    """
    places, _ = W.run_places(part, gram)
    held = W.runs(hashes, gram)[places] if len(places) else np.zeros(0, np.uint64)
    known, first = np.unique(held, return_index=True)
    starts = places[first[np.isin(known, recurring)]]
    if not len(starts):
        return starts
    symbols = (hashes >> np.uint64(33)).astype(np.int64)
    machine = _automaton(symbols, starts, gram)
    ends = np.fromiter((end for end, _ in machine.iter(tuple(symbols.tolist()))), np.int64)
    found = ends - (gram - 1)
    inside = np.searchsorted(part.first, found, side="right") == np.searchsorted(part.first, ends, side="right")
    return found[inside]


def candidate_windows(
    part: W.Slice, hashes: np.ndarray, recurring: np.ndarray, window: int = WINDOW, gram: int = GRAM
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows that hold a recurring phrase, each once per document, and their documents."""
    places, owners = W.run_places(part, window)
    found = occurrences(part, hashes, recurring, gram)
    if not len(places) or not len(found):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    marks = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(marks, np.maximum(found - (window - gram), 0), 1)
    np.add.at(marks, found + 1, -1)
    near = np.cumsum(marks)[places] > 0
    return W.distinct(W.runs(hashes, window)[places[near]], owners[near])


def removed_words(part: W.Slice, hashes: np.ndarray, earlier: np.ndarray, owner: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Which words go: those in a window whose hash is `earlier` for its document, or came before in the document."""
    places, owners = W.run_places(part, window)
    cover = np.zeros(len(hashes) + 1, np.int64)
    if len(places):
        values = W.runs(hashes, window)[places]
        order = np.argsort(values, kind="stable")
        order = order[np.argsort(owners[order], kind="stable")]
        again = np.zeros(len(values), bool)
        again[order[1:]] = (values[order[1:]] == values[order[:-1]]) & (owners[order[1:]] == owners[order[:-1]])
        salt = W.mix64(np.arange(1, part.size + 1, dtype=np.uint64))
        gone = places[again | np.isin(values ^ salt[owners], earlier ^ salt[owner])]
        np.add.at(cover, gone, 1)
        np.add.at(cover, gone + window, -1)
    return np.cumsum(cover)[:-1] > 0


def repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of documents: doc_id, n_words, n_removed, kept_sha256 and removed: spans of removed words (first, end).

    Words are runs without ASCII white space, unchanged. A word goes if a window of `window` words covers it whose
    words also start earlier: in a document with a smaller doc_id, or before in the same document. Null and empty texts have no words.
    Rows without doc_id come after all others. Rows with one doc_id are one place in the order: what one of
    them repeats of the other stays. No rows give no rows.
    """
    ship_package()
    read = materialize(_read(documents, window), "phrase-documents")
    same = ["n_words", "key1", "key2"]
    # Equal word sequences: all but the first doc_id go as a whole.
    firsts = read.where(F.col("n_words") >= window).groupBy(*same).agg(F.min("place").alias("place"))
    owned = read.join(firsts, [*same, "place"], "left_semi").select("place", F.explode("anchors").alias("anchor"))
    recurring = owned.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    wanted = owned.join(recurring, "anchor").groupBy("place").agg(F.collect_set("anchor").alias("anchors"))
    texts = documents.select(_place(F.col("doc_id")).alias("place"), "text")
    routed = materialize(texts.join(wanted, "place"), "phrase-routed")

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = W.Hasher()
        for batch in batches:
            for part in W.slices(batch["text"]):
                wanted = batch["anchors"].slice(part.row, part.size).flatten().to_numpy().view(np.uint64)
                value, owner = candidate_windows(part, hasher.words(part), np.unique(wanted), window)
                own = batch["place"].slice(part.row, part.size).take(pa.array(owner))
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), own], ["window", "place"])

    windows = materialize(routed.mapInArrow(locate, "window long, place long"), "phrase-windows")
    earliest = windows.groupBy("window").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    earliest = earliest.where("first < last").select("window", "first")
    later = windows.join(earliest, "window").where("place > first")
    later = later.groupBy("place").agg(F.collect_set("window").alias("windows"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = W.Hasher()
        for batch in batches:
            for part in W.slices(batch["text"]):
                hashes = hasher.words(part)
                listed = batch["windows"].slice(part.row, part.size).fill_null([])
                value = listed.flatten().to_numpy().view(np.uint64)
                owner = np.repeat(np.arange(part.size), np.diff(listed.offsets.to_numpy()))
                gone = removed_words(part, hashes, value, owner, window)
                digests, spans = [], []
                for d in range(part.size):
                    own = gone[part.first[d] : part.first[d + 1]]
                    digests.append(hashlib.sha256(b" ".join(compress(_raw_words(part, d), ~own))).hexdigest())
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]])))
                    spans.append([{"first": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["place"].slice(part.row, part.size),
                        *map(pa.array, sequence_keys(part, hashes, hasher)),
                        pa.array([sum(s["end"] - s["first"] for s in x) for x in spans], pa.int64()),
                        pa.array(digests, pa.string()),
                        pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
                    ],
                    ["place", "key1", "key2", "n_removed", "kept_sha256", "removed"],
                )

    schema = "place long, key1 long, key2 long, n_removed long, kept_sha256 string, removed array<struct<first:long,end:long>>"
    changed = routed.drop("anchors").join(later, "place", "left").mapInArrow(remove, schema)
    changed = changed.dropDuplicates(["place", "key1", "key2"])

    copies = firsts.select(*same, F.col("place").alias("first_place"))
    judged = read.drop("anchors").join(copies, same, "left").join(changed, ["place", "key1", "key2"], "left")
    whole = F.coalesce(F.col("first_place") < F.col("place"), F.lit(False))
    all_words = F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("n_words").alias("end")))
    none = F.array().cast("array<struct<first:long,end:long>>")
    return judged.select(
        "doc_id",
        "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(_EMPTY)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
        F.when(whole, all_words).otherwise(F.coalesce("removed", none)).alias("removed"),
    )


def drop_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with repeated passages cut out of `text` (kept words joined by one space); texts that lose no word
    stay as they are."""
    found = repeats(documents, window).where("n_removed > 0").select(
        F.col("doc_id").alias("__id"), F.col("n_words").alias("__words"), F.col("removed").alias("__removed")
    )
    found = found.dropDuplicates(["__id", "__words"])

    @F.arrow_udf("string")
    def cut(texts: pa.Array, removed: pa.Array) -> pa.Array:
        out = []
        for text, spans in zip(texts.to_pylist(), removed.to_pylist()):
            if spans is not None:
                words = text.encode().split()
                for span in reversed(spans):
                    del words[span["first"] : span["end"]]
                text = b" ".join(words).decode()
            out.append(text)
        return pa.array(out, pa.string())

    rows = documents.withColumn("__n", F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)))
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__n") == F.col("__words")), "left")
    return joined.withColumn("text", cut(F.col("text"), F.col("__removed"))).select(*documents.columns)
