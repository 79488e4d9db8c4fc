"""Alignment of two tokenizers' tokens over the same text, by merging both sequences in lockstep.

All documents of a block are merged at once: one vector holds the current A token of every document, another the current
B token. A step links the two, ends a group where both end at the same byte, and advances the one that ends first, or
both. Documents that are done leave the vectors. A very long document is cut at shared ends and merged in several
places at once, so the number of steps does not grow with the longest text.

How often a pair of ids is linked in the corpus is counted per block first; the counts come back to a block as one row per
pair of the block, so neither shuffle holds a row per link.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from msgflow.llm.bpe import PrefixEncoder, id_and_text, pieces
from msgflow.llm.tables import materialize
from msgflow.session import ship_package

# UTF-8 bytes of text in a block, or one document if that is longer.
BLOCK_BYTES = 4 << 20
# A document with more A tokens is merged in several places at once.
LANE = 2048


@dataclass
class Tokens:
    """Tokens of both sides of some documents: `first[d]:first[d + 1]` are those of document d; ends are byte places
    counted over all documents, the same on both sides."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray


@dataclass
class Merged:
    """Links and cuts as places in the token arrays, the cuts in order: a group ends with these tokens."""

    link_a: np.ndarray
    link_b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray


class Tokenizers:
    """A byte-level vocabulary file (A) and a piece model with byte fallback (B), as bytes of both files."""

    def __init__(self, raw_a: bytes, raw_b: bytes):
        self.a = PrefixEncoder(raw_a.decode())
        self.b = SentencePieceProcessor(model_proto=raw_b)
        self.bytes_a = self.a.bytes
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.lengths_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.lengths_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.digits = _digit_rows(max(len(self.bytes_a), len(self.bytes_b)))

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("\u2581", " ").encode()

    def encode(self, texts: Iterable[str]) -> Tokens:
        """Tokens of texts; none where a text is empty or where B does not give its bytes back (A always does)."""
        texts = list(texts)
        own_a, own_b = [], []
        none = np.zeros(0, np.int32)
        for text, packed in zip(texts, self.a.encode_all((" " + t for t in texts), added=False)):
            ids = self.b.encode(text) if text else []
            same = bool(text) and b"".join(map(self.bytes_b.__getitem__, ids)) == (" " + text).encode()
            own_a.append(np.frombuffer(packed, "<i4") if same else none)
            own_b.append(np.array(ids, np.int32) if same else none)
        ids_a, first_a = _flat(own_a)
        ids_b, first_b = _flat(own_b)
        ends_a, ends_b = np.cumsum(self.lengths_a[ids_a]), np.cumsum(self.lengths_b[ids_b])
        return Tokens(ids_a, ids_b, first_a, first_b, ends_a, ends_b)


def _flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    first = np.zeros(len(rows) + 1, np.int64)
    np.cumsum([len(r) for r in rows], out=first[1:])
    return np.concatenate([*rows, np.zeros(0, np.int32)]), first


def lanes(tokens: Tokens, longest: int = LANE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First A and B tokens of all lanes, and the A tokens where they stop: each document with tokens, long ones in
    several lanes that start behind a shared end."""
    first_a, first_b = tokens.first_a, tokens.first_b
    has = np.flatnonzero(np.diff(first_a) > 0)
    begin_a, begin_b, stop_a = [first_a[has]], [first_b[has]], [first_a[has + 1]]
    for d in has[np.diff(first_a)[has] > longest].tolist():
        at, end = int(first_a[d]) + longest, int(first_a[d + 1])
        while at < end:
            window = tokens.ends_a[at : min(at + longest, end)]
            places = np.searchsorted(tokens.ends_b, window)
            shared = np.flatnonzero(tokens.ends_b[places] == window)
            if len(shared) and at + shared[0] + 1 < end:
                begin_a.append(np.array([at + shared[0] + 1]))
                begin_b.append(np.array([places[shared[0]] + 1]))
                stop_a.append(np.array([end]))
                at += int(shared[0]) + 1
            at += longest
    begin_a, begin_b, stop_a = (np.concatenate(x) for x in (begin_a, begin_b, stop_a))
    order = np.argsort(begin_a, kind="stable")
    begin_a, begin_b, stop_a = begin_a[order], begin_b[order], stop_a[order]
    stop_a[:-1] = np.minimum(stop_a[:-1], begin_a[1:])
    return begin_a.astype(np.int32), begin_b.astype(np.int32), stop_a.astype(np.int32)


def lockstep(tokens: Tokens, longest: int = LANE) -> Merged:
    """Merge the tokens of all documents: every overlapping pair is a link, every shared end a cut."""
    a, b, stop = lanes(tokens, longest)
    parts: list[list[np.ndarray]] = [[], [], [], []]
    while len(a):
        end_a, end_b = tokens.ends_a[a], tokens.ends_b[b]
        cut = end_a == end_b
        for part, values in zip(parts, (a, b, a[cut], b[cut])):
            part.append(values)
        a, b = a + (end_a <= end_b), b + (end_b <= end_a)
        going = a < stop
        if not going.all():
            a, b, stop = a[going], b[going], stop[going]
    link_a, link_b, cut_a, cut_b = (np.concatenate(p) if p else np.zeros(0, np.int32) for p in parts)
    return Merged(link_a, link_b, np.sort(cut_a), np.sort(cut_b))


def _digit_rows(size: int) -> np.ndarray:
    """Decimal digits of the ids below `size`, left-aligned in eight bytes, as one number each."""
    if size > 10_000_000:
        raise ValueError("Ids of more than seven digits")
    return np.array([str(i).encode() for i in range(size)], "S8").view(np.uint64)


def group_texts(tokens: Tokens, merged: Merged, digits: np.ndarray) -> Iterator[bytes]:
    """Per document `a1,a2|b1;a3|b2,b3`: the ids of both sides group by group."""
    n_a, n_b = len(tokens.ids_a), len(tokens.ids_b)
    # An A token comes behind the B tokens of the groups before its own, a B token also behind the A tokens of its own.
    sizes_a, sizes_b = (np.diff(cut, prepend=-1) for cut in (merged.cut_a, merged.cut_b))
    at_a = np.arange(n_a) + np.repeat(merged.cut_b + 1 - sizes_b, sizes_a)
    at_b = np.arange(n_b) + np.repeat(merged.cut_a + 1, sizes_b)
    rows = np.zeros(n_a + n_b, np.uint64)
    rows[at_a], rows[at_b] = digits[tokens.ids_a], digits[tokens.ids_b]
    letters = rows.view(np.uint8)
    letters[7::8] = ord(",")
    letters[8 * at_a[merged.cut_a] + 7] = ord("|")
    letters[8 * at_b[merged.cut_b] + 7] = ord(";")
    first = tokens.first_a + tokens.first_b
    letters[8 * first[1:][np.diff(first) > 0] - 1] = 0
    held = letters != 0
    places = np.concatenate([[0], np.cumsum(held.reshape(-1, 8).sum(axis=1, dtype=np.int8), dtype=np.int64)])[first]
    text = letters[held].tobytes()
    for low, high in zip(places[:-1].tolist(), places[1:].tolist()):
        yield text[low:high]


def _shared(documents: DataFrame, path_a: str, path_b: str):
    """Both vocabularies for all tasks: the files are read once, each worker builds the tokenizers once."""
    raw = []
    for path in (path_a, path_b):
        with open(path, "rb") as f:
            raw.append(f.read())
    held = documents.sparkSession.sparkContext.broadcast({"raw": raw})

    def tokenizers() -> Tokenizers:
        if "built" not in held.value:
            held.value["built"] = Tokenizers(*held.value["raw"])
        return held.value["built"]

    return tokenizers


def align(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row of documents: doc_id, a and b (ids of both tokenizers), cuts (how many tokens of a and of b lie in front of
    each end that both share; the groups lie between them), links (places in a and b of tokens whose bytes overlap).

    A encodes a space and the text, B the text, which adds that space itself. Strings of special tokens inside a text are
    plain text. A text that is null or empty, or whose bytes one side does not give back (it normalises them), has no
    tokens. Texts of any length are taken as a whole. Every row gives a row, also repeated ones and those without doc_id;
    no rows give no rows. Other columns are not looked at.
    """
    ship_package()
    tokenizers = _shared(documents, path_a, path_b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizers()
        for ids, texts in pieces(batches, BLOCK_BYTES):
            tokens = own.encode(texts)
            merged = lockstep(tokens)
            order = np.lexsort((merged.link_b, merged.link_a))
            link_a, link_b = merged.link_a[order], merged.link_b[order]
            first_a, first_b = tokens.first_a, tokens.first_b
            columns = [ids, _lists(tokens.ids_a, first_a), _lists(tokens.ids_b, first_b)]
            for left, right, more in ((merged.cut_a, merged.cut_b, 1), (link_a, link_b, 0)):
                first = np.searchsorted(left, first_a)
                base = np.repeat(np.arange(len(ids)), np.diff(first))
                pair = [left - first_a[base] + more, right - first_b[base] + more]
                values = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in pair], ["a", "b"])
                columns.append(pa.ListArray.from_arrays(pa.array(first, pa.int32()), values))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "a", "b", "cuts", "links"])

    pair = "array<struct<a:long,b:long>>"
    return id_and_text(documents).mapInArrow(run, f"doc_id long, a array<int>, b array<int>, cuts {pair}, links {pair}")


def _lists(values: np.ndarray, first: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, pa.int32()))


_DOCUMENT = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_COUNTED = f"{_DOCUMENT}, places array<int>, times array<int>, a int, b int, place int, docs long"


def _counted(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows of two kinds per block: its documents with the linked pairs they hold (places in the block's list of pairs,
    and how often), and the block's pairs with the number of its documents that hold them."""
    tokenizers = _shared(documents, path_a, path_b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizers()
        schema = pa.schema(
            [(n, {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(t, pa.list_(pa.int32())))
             for n, t in (field.split() for field in _COUNTED.split(", "))]
        )
        for block, (ids, texts) in enumerate(pieces(batches, BLOCK_BYTES)):
            block += TaskContext.get().partitionId() << 32
            tokens = own.encode(texts)
            merged = lockstep(tokens)
            n, first_a, first_b = len(ids), tokens.first_a, tokens.first_b
            owner = np.searchsorted(first_a, merged.link_a, side="right") - 1
            pair = (tokens.ids_a[merged.link_a].astype(np.int64) << 32) | tokens.ids_b[merged.link_b]
            place, pairs = pd.factorize(pair)
            held, times = _counted_keys(owner * max(len(pairs), 1) + place)
            holder, place = np.divmod(held, max(len(pairs), 1))
            first = np.searchsorted(holder, np.arange(n + 1))
            digests = [hashlib.sha256(t).hexdigest() if t else "" for t in group_texts(tokens, merged, own.digits)]
            columns = {
                "block": np.full(n, block),
                "doc_id": ids,
                "n_a": np.diff(first_a),
                "n_b": np.diff(first_b),
                "n_groups": np.diff(np.searchsorted(merged.cut_a, first_a)),
                "n_links": np.bincount(owner, minlength=n),
                "groups_sha256": pa.array(digests, pa.string()),
                "places": _lists(place, first),
                "times": _lists(times, first),
            }
            yield _batch(columns, n, schema)
            columns = {
                "block": np.full(len(pairs), block),
                "a": (pairs >> 32).astype(np.int32),
                "b": (pairs & 0xFFFFFFFF).astype(np.int32),
                "place": np.arange(len(pairs), dtype=np.int32),
                "docs": np.bincount(place, minlength=len(pairs)),
            }
            yield _batch(columns, len(pairs), schema)

    return id_and_text(documents).mapInArrow(run, _COUNTED)


def _counted_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each comes."""
    code, distinct = pd.factorize(keys)
    order = np.argsort(distinct)
    return distinct[order], np.bincount(code, minlength=len(distinct))[order]


def _batch(columns: dict, size: int, schema: pa.Schema) -> pa.RecordBatch:
    own = [
        pa.array(columns[f.name], f.type) if isinstance(columns.get(f.name), np.ndarray) else columns.get(f.name)
        for f in schema
    ]
    filled = [pa.nulls(size, f.type) if c is None else c for f, c in zip(schema, own)]
    return pa.RecordBatch.from_arrays(filled, schema=schema)


def alignment_report(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row of documents: doc_id, n_a and n_b (tokens), n_groups, n_links, n_best, count_sum, groups_sha256.

    Groups and links are those of `align`. A pair's count is the number of documents (rows) that hold it linked; n_best are
    the links whose count is the highest of their A id, count_sum the counts of all links. groups_sha256 is the digest of
    `a1,a2|b1;a3|b2,b3`, the ids of all groups. Rows without tokens (see `align`) have zeros and an empty digest. Ties of
    the highest count all count. No rows give no rows.

    The best counts are broadcast: one row per id of A's vocabulary at most.
    """
    ship_package()
    table = materialize(_counted(documents, path_a, path_b), "alignment-blocks")
    pairs = table.where("a is not null").select("block", "place", "a", "b", "docs")
    counts = pairs.groupBy("a", "b").agg(F.sum("docs").alias("count"))
    best = counts.groupBy("a").agg(F.max("count").alias("best"))
    scored = pairs.join(counts, ["a", "b"]).join(F.broadcast(best), "a")
    scored = scored.select("block", "place", "count", (F.col("count") == F.col("best")).cast("long").alias("is_best"))

    def score(held: pa.Table, scored: pa.Table) -> pa.Table:
        places = scored["place"].to_numpy()
        listed = held["places"].combine_chunks()
        times = held["times"].combine_chunks().flatten().to_numpy().astype(np.int64)
        at = np.concatenate([[0], np.cumsum(listed.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        at_place = listed.flatten().to_numpy()
        out = held.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
        for name, column in (("n_best", "is_best"), ("count_sum", "count")):
            value = np.zeros(len(places), np.int64)
            value[places] = scored[column].to_numpy()
            total = np.concatenate([[0], np.cumsum(value[at_place] * times)])
            out = out.append_column(name, pa.array(total[at[1:]] - total[at[:-1]], pa.int64()))
        return out.append_column("groups_sha256", held["groups_sha256"])

    held = table.where("a is null").withColumn("holder", F.col("block") + 0).drop("block", "a", "b", "place", "docs")
    schema = _DOCUMENT.replace("block long, ", "").replace("groups_sha256", "n_best long, count_sum long, groups_sha256")
    return held.groupBy("holder").cogroup(scored.groupBy("block")).applyInArrow(score, schema)
