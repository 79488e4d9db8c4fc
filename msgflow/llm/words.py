"""Words of Arrow text columns as numbers: vectorised over the UTF-8 bytes of a slice of documents.

Words are runs of bytes outside a set of separators, so no text is decoded. Hashes are 64 bits wide and the same
on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# White space of the contracts' word pattern: space and the control characters 9 to 13.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
# Every ASCII character but letters divides words of letters.
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[128:] = False
NOT_LETTER[65:91] = NOT_LETTER[97:123] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_GOLDEN = 0x9E3779B97F4A7C15
_BASE = 0xD1342543DE82EF95
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64 over unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_codes() -> np.ndarray:
    """A random-looking number for each byte value."""
    return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_GOLDEN))


@dataclass
class Slice:
    """Some whole documents. `first[d]:first[d + 1]` are the words of document d; starts and ends are byte places."""

    row: int
    size: int
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(self.size), self.counts())


def slices(
    texts: pa.Array, separators: np.ndarray = SPACE, lower: bool = False, slice_bytes: int = 1 << 20
) -> Iterator[Slice]:
    """Cut a text column (null: empty) into slices of about `slice_bytes`, or one document if that is longer."""
    column = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return
    places = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(places, places[row] + slice_bytes, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        own = data[places[row] : places[end]]
        yield _slice(row, LOWER[own] if lower else own, places[row : end + 1] - places[row], separators)
        row = end


def _slice(row: int, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> Slice:
    inside = ~separators[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    after = np.empty_like(inside)
    before = np.empty_like(inside)
    if len(data):
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Slice(row, len(offsets) - 1, data, offsets, starts, ends, np.searchsorted(starts, offsets))


class Hasher:
    """Hashes of words: a polynomial over byte codes modulo 2**64, then mixed. Keeps the powers it has computed."""

    def __init__(self) -> None:
        self.codes = byte_codes()
        self.powers = np.ones(1, np.uint64)
        self.inverses = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        """Have the first n powers at hand."""
        if n > len(self.powers):
            n = max(n, 1 << 16)
            for name, base in (("powers", _BASE), ("inverses", _BASE_INVERSE)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Running sums of the polynomial, with a zero in front."""
        self.grow(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.codes[data] * self.powers[: len(data)], out=out[1:], dtype=np.uint64)
        return out

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the bytes from starts to ends."""
        return mix64((sums[ends] - sums[starts]) * self.inverses[starts])

    def words(self, part: Slice) -> np.ndarray:
        return self.spans(self.sums(part.data), part.starts, part.ends)


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every `length` neighbours of an array, also across documents."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(length):
        out = out * np.uint64(_BASE) + hashes[k : k + n]
    return mix64(out)


def run_places(part: Slice, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of all runs of `length` words inside one document, and the documents that own them."""
    counts = np.maximum(part.counts() - (length - 1), 0)
    owners = np.repeat(np.arange(part.size), counts)
    within = np.arange(len(owners)) - np.repeat(np.cumsum(counts) - counts, counts)
    return part.first[owners] + within, owners


def shingles(part: Slice, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of `length` words and their owners; a shorter text is one shingle as a whole."""
    places, owners = run_places(part, length)
    whole = runs(hashes, length)[places] if len(places) else np.zeros(0, np.uint64)
    counts = part.counts()
    short = np.flatnonzero((counts > 0) & (counts < length))
    if len(short):
        value = np.zeros(len(short), np.uint64)
        for k in range(length - 1):
            has = counts[short] > k
            value[has] = value[has] * np.uint64(_BASE) + hashes[part.first[short][has] + k]
        whole = np.concatenate([whole, mix64(value ^ counts[short].astype(np.uint64))])
        owners = np.concatenate([owners, short])
    return whole, owners


def distinct(values: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each owner's distinct values, sorted by owner and value."""
    order = np.argsort(values)
    order = order[np.argsort(owners[order], kind="stable")]
    values, owners = values[order], owners[order]
    if len(values):
        keep = np.ones(len(values), bool)
        keep[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
        values, owners = values[keep], owners[keep]
    return values, owners


def lists(values: np.ndarray, owners: np.ndarray, size: int, kind: pa.DataType) -> pa.ListArray:
    """One list per document from values sorted by owner."""
    offsets = np.zeros(size + 1, np.int32)
    np.cumsum(np.bincount(owners, minlength=size), out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
