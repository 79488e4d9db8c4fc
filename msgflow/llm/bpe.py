"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

The encoding of a prefix has one last token, and the encoding without it is that of the shorter prefix. So one token per
prefix describes all encodings:

1. An automaton of all token texts with suffix links reports, at every byte, the tokens that are suffixes of the prefix.
2. Such a token is the prefix's last one if it stays apart from the last token of the prefix in front of it, that is, if
   no merge would ever cross the border between the two. This holds for one token only, and it is stored.
3. Following the stored tokens back from the end gives the ids.

Texts are first divided as byte-level tokenizers do, so pieces are short. All new pieces of some texts go through the
three steps together, byte by byte, as arrays; the encodings of the latest pieces are remembered.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from hashlib import sha256
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from msgflow.session import ship_package

# Fixed value: how byte-level pre-tokenizers divide a text.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Remembered pieces (twice: the latest and those before them) and tested token pairs, so a worker's memory is bounded.
REMEMBERED = 1 << 17
REMEMBERED_LENGTH = 64
PAIR_BITS = 20
# Characters of text whose new pieces are encoded together.
TOGETHER = 1 << 20
# Stands between pieces; in no token, as these are given with one letter below 256 per byte.
_GAP = chr(256)
# Letters and digits up to here have the same class in all versions of Unicode in use.
_SETTLED = "\u0557"
# Stand-ins of the classes letter, number and other: their place in the pattern is that of their class.
_STAND_INS = {"letter": "\u0436", "number": "1", "other": "\u00a7", "space": " "}
_FOREVER = 1 << 62
_SPREAD, _POSITIVE = 0x1E3779B97F4A7C15, (1 << 63) - 1
# UTF-8 bytes of text whose ids a worker holds at once, or one document if that is longer.
PIECE_BYTES = 4 << 20


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: visible Latin-1 characters for themselves, the
    others for the letters from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class PrefixEncoder:
    """Encoder and decoder of one byte-level vocabulary file (the JSON of the tokenizers library)."""

    def __init__(self, raw: str):
        spec = json.loads(raw)
        model, letters = spec["model"], byte_letters()
        pre = spec.get("pre_tokenizer") or {}
        plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        if model.get("type", "BPE") != "BPE" or not plain or spec.get("normalizer") or pre.get("type") != "ByteLevel":
            raise ValueError("Only byte-level BPE vocabularies without a normalizer are supported")
        if pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError("Only the division of texts by pattern, without a space in front, is supported")
        vocab: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = 1 + max([*vocab.values(), *self.added.values()])
        self.bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes[i] = bytes(letters[c] for c in token)
        self.rank, self.left, self.right = [-1] * size, [0] * size, [0] * size
        self.merges: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            made = vocab[a + b]
            if self.rank[made] >= 0:
                raise ValueError("A token with two merges has no unique history")
            self.merges[vocab[a], vocab[b]] = rank
            self.rank[made], self.left[made], self.right[made] = rank, vocab[a], vocab[b]
        if not {bytes([b]) for b in range(256)} <= set(self.bytes):
            raise ValueError("Some bytes have no token")
        for token, i in self.added.items():
            self.bytes[i] = token.encode()
        self.packed = [int(i).to_bytes(4, "little") for i in range(size)]
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.single = np.zeros(256, np.int64)
        for i in vocab.values():
            if len(self.bytes[i]) == 1:
                self.single[self.bytes[i][0]] = i
        # Tokens of one byte are suffixes everywhere and need no automaton.
        self.suffixes = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i in vocab.values():
            if self._reachable(i):
                self.suffixes.add_word(self.bytes[i].decode("latin-1"), i)
        self.suffixes.make_automaton()
        self.tested = np.full(1 << PAIR_BITS, -1, np.int64)
        self.fitting = np.zeros(1 << PAIR_BITS, bool)
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.split = regex.compile(PIECES)
        self.unsettled = regex.compile(f"[^\\x00-{_SETTLED}]")
        longest_first = sorted(self.added, key=len, reverse=True)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.added else None
        self.library = Tokenizer.from_str(raw).pre_tokenizer
        self.classes: dict[str, str | None] = {}

    def _reachable(self, token: int) -> bool:
        """Whether the token's own text is encoded as the token: its halves stay apart until its own merge."""
        return self.rank[token] >= 0 and self.apart(self.left[token], self.right[token], self.rank[token])

    def apart(self, a: int, b: int, limit: int = _FOREVER) -> bool:
        """Whether no merge crosses the border between the tokens a and b up to the merge number `limit`.

        Both tokens are undone step by step, the one merged last first. Their parts at the border meet until the
        earlier of the merges that swallowed them; a merge of both parts before that would have crossed the border. Of
        equal merges the left one comes first, so a merge across the border beats one in b of the same number.
        """
        while True:
            across = self.merges.get((a, b))
            if across is not None and across < limit:
                return False
            if self.rank[a] > self.rank[b]:
                limit, a = self.rank[a], self.right[a]
            elif self.rank[b] >= 0:
                limit, b = self.rank[b] + 1, self.left[b]
            else:
                return True

    def fit(self, front: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether the tokens stay apart from those in front of them; tested pairs are remembered."""
        pair = front * len(self.bytes) + token
        slot = (pair * _SPREAD & _POSITIVE) >> (63 - PAIR_BITS)
        new = np.flatnonzero(self.tested[slot] != pair)
        out = self.fitting[slot]
        if len(new):
            pairs, at = np.unique(pair[new], return_inverse=True)
            own = np.array([self.apart(*divmod(p, len(self.bytes))) for p in pairs.tolist()], bool)
            out[new] = own[at]
            self.tested[slot[new]], self.fitting[slot[new]] = pair[new], out[new]
        return out

    def last_tokens(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The last token of each prefix's encoding, for all bytes of all pieces with a gap between two; and where each piece
        starts."""
        sizes = np.array([len(p) for p in pieces], np.int64)
        starts = np.cumsum(sizes + 1) - sizes - 1
        last = self.single[np.frombuffer(b"\0".join(pieces), np.uint8)]
        text = _GAP.join([p.decode("latin-1") for p in pieces])
        found = np.fromiter(chain.from_iterable(self.suffixes.iter(text)), np.int64)
        end, token = found[::2], found[1::2]
        place = end - starts[np.searchsorted(starts, end, side="right") - 1]
        before = end - self.lengths[token]
        whole = place < self.lengths[token]
        order = np.argsort(place, kind="stable")
        bounds = np.searchsorted(place[order], np.arange(int(sizes.max(initial=0)) + 1))
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            rows = order[low:high]
            if not len(rows):
                continue
            # At most one token fits a prefix; where none of these does, it is the one of a single byte.
            fits = whole[rows]
            inner = np.flatnonzero(~fits)
            fits[inner] = self.fit(last[before[rows[inner]]], token[rows[inner]])
            last[end[rows[fits]]] = token[rows[fits]]
        return last, starts

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Packed ids of pieces of texts: the stored tokens are followed from all ends at once."""
        if not pieces:
            return []
        raw = [p.encode() for p in pieces]
        last, starts = self.last_tokens(raw)
        piece, end = np.arange(len(raw)), starts + np.array([len(p) for p in raw]) - 1
        owners, tokens = [], []
        while len(piece):
            token = last[end]
            owners.append(piece)
            tokens.append(token)
            end = end - self.lengths[token]
            going = end >= starts[piece]
            piece, end = piece[going], end[going]
        # The last step holds the first tokens.
        owner, token = np.concatenate(owners[::-1]), np.concatenate(tokens[::-1])
        packed = token[np.argsort(owner, kind="stable")].astype("<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(owner, minlength=len(raw)))).tolist()
        return [packed[low:high] for low, high in zip([0, *ends], ends)]

    def _class_of(self, c: str) -> str | None:
        """A stand-in where this library's character class differs from that of the tokenizers library, else null."""
        if c not in self.classes:
            probes = (("letter", "a"), ("number", "1"), ("other", "!"))
            theirs = next((k for k, p in probes if len(self.library.pre_tokenize_str(p + c)) == 1), "space")
            ours = next((k for k, p in probes if len(self.split.findall(p + c)) == 1), "space")
            self.classes[c] = None if theirs == ours else _STAND_INS[theirs]
        return self.classes[c]

    def divide(self, text: str) -> list[str]:
        """Pieces of a text without added tokens, as the tokenizers library divides it."""
        new = {c: self._class_of(c) for c in set(self.unsettled.findall(text))}
        stand_ins = {ord(c): s for c, s in new.items() if s}
        if not stand_ins:
            return self.split.findall(text)
        return [text[m.start() : m.end()] for m in self.split.finditer(text.translate(stand_ins))]

    def encode(self, text: str, added: bool = True) -> bytes:
        """Ids of a text, four bytes each, lowest first. Added tokens inside the text are tokens, or plain text if not
        ``added``."""
        return next(self.encode_all([text], added))

    def encode_all(self, texts: Iterable[str], added: bool = True) -> Iterator[bytes]:
        """Ids of each text. The pieces that are new in about TOGETHER characters of text are encoded together."""
        held, size = [], 0
        for text in texts:
            held.append(self._divided(text, added))
            size += len(text)
            if size >= TOGETHER:
                yield from self._join(held)
                held, size = [], 0
        yield from self._join(held)

    def _divided(self, text: str, added: bool) -> list[str | bytes]:
        """Pieces of a text, added tokens as packed ids among them."""
        if not added or self.specials is None or self.specials.search(text) is None:
            return self.divide(text)
        parts = self.specials.split(text)
        return [x for k, p in enumerate(parts) for x in ([self.packed[self.added[p]]] if k % 2 else self.divide(p))]

    def _join(self, texts: list[list[str | bytes]]) -> list[bytes]:
        known = self.pieces
        new = set().union(*texts) - known.keys()
        older = new & self.older.keys()
        unknown = [p for p in new - older if isinstance(p, str)]
        known |= {p: self.older[p] for p in older}
        known |= zip(unknown, self.encode_pieces(unknown))
        known |= {p: p for p in new if isinstance(p, bytes)}
        out = [b"".join(map(known.__getitem__, text)) for text in texts]
        for piece in new:
            if isinstance(piece, bytes) or len(piece) > REMEMBERED_LENGTH:
                del known[piece]
        if len(known) >= REMEMBERED:
            self.pieces, self.older = {}, known
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids, added tokens included; bytes that are no UTF-8 become replacement characters."""
        return b"".join([self.bytes[i] for i in ids]).decode("utf-8", "replace")


def _shared(documents: DataFrame, path: str):
    """A vocabulary for all tasks: its file is read once, and each worker builds the encoder once."""
    with open(path, encoding="utf-8") as f:
        held = documents.sparkSession.sparkContext.broadcast({"raw": f.read()})

    def encoder() -> PrefixEncoder:
        if "encoder" not in held.value:
            held.value["encoder"] = PrefixEncoder(held.value["raw"])
        return held.value["encoder"]

    return encoder


def id_and_text(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def pieces(batches: Iterator[pa.RecordBatch], size: int = PIECE_BYTES) -> Iterator[tuple[pa.Array, Iterator[str]]]:
    """Doc ids and texts (null: empty) of about `size` bytes; a text is made only when it is asked for."""
    for batch in batches:
        ids, texts = batch["doc_id"], batch["text"]
        ends = np.cumsum(np.nan_to_num(pc.binary_length(texts).to_numpy(zero_copy_only=False)))
        row = 0
        while row < len(batch):
            done = ends[row - 1] if row else 0
            end = max(row + 1, int(np.searchsorted(ends, done + size, side="right")))
            yield ids.slice(row, end - row), (t.as_py() or "" for t in texts.slice(row, end - row))
            row = end


def encode(documents: DataFrame, path: str) -> DataFrame:
    """Per row of documents: doc_id and ids, the whole text's token ids by the vocabulary file at `path`.

    The ids are those of the tokenizers library without special tokens around the text; strings of added tokens inside
    it are tokens. Null and empty texts have no ids. A text of any length takes time and memory in proportion to it,
    also without any place to divide it. Every row gives a row, repeated ones and those without doc_id, too; no rows
    give no rows. Other columns are not looked at. The vocabulary file is sent to all workers: its size is the model's.
    """
    ship_package()
    encoder = _shared(documents, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder()
        for doc_ids, texts in pieces(batches):
            packed = list(own.encode_all(texts))
            offsets = np.zeros(len(packed) + 1, np.int32)
            np.cumsum([len(p) // 4 for p in packed], out=offsets[1:])
            values = np.frombuffer(b"".join(packed), "<i4")
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays([doc_ids, ids], ["doc_id", "ids"])

    return id_and_text(documents).mapInArrow(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """Rows of `encode` with their text as a further column, `decoded`. Null ids give an empty text."""
    ship_package()
    encoder = _shared(tokens, path)

    @F.arrow_udf(T.StringType())
    def text(ids: pa.Array) -> pa.Array:
        own = encoder()
        return pa.array((own.decode(x.as_py() or []) for x in ids), pa.string())

    return tokens.withColumn("decoded", text("ids"))


def encode_report(documents: DataFrame, path: str) -> DataFrame:
    """Per row of documents: doc_id, n_tokens, ids_sha256 (of the ids as little-endian unsigned 32-bit integers) and
    decoded_sha256 (of the text that the ids decode to). Encoding, decoding and special cases as in `encode`."""
    ship_package()
    encoder = _shared(documents, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder()
        for doc_ids, texts in pieces(batches):
            rows = []
            for ids in own.encode_all(texts):
                decoded = own.decode(np.frombuffer(ids, "<u4").tolist())
                rows.append((len(ids) // 4, sha256(ids).hexdigest(), sha256(decoded.encode()).hexdigest()))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string()))]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            yield pa.RecordBatch.from_arrays([doc_ids, *columns], names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return id_and_text(documents).mapInArrow(run, schema)
