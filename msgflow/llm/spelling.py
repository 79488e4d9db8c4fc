"""Spelling variants: words one inserted, deleted or replaced letter apart, and the frequent form each leads to.

The near words of a vocabulary are found with a bit-sliced position index: for every (position, letter) a bitset over the
words that have this letter there. A query word is read letter by letter; a few word-parallel operations per letter keep
four sets up to date at once: words equal so far, and words with one replaced, one missing or one additional letter so
far, the last two matched at positions shifted by one.

A whole vocabulary against itself would be quadratic, so it is divided first. Two words of n letters or of n and n + 1, one
error apart, agree in their first or in their last n // 2 letters. Words are grouped by these letters; small groups
share one index, large groups are dealt into tiles, so no task holds a group of any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow.llm.tables import materialize
from msgflow.session import ship_package

LETTERS = r"[A-Za-zÀ-ÿ]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEAST_LETTERS = 6
LEAST_TIMES = 5
# A form has at least so many times the occurrences of its variant.
RATIO = 5
# One run in so many, by its hash, loses a letter (the contract's misspellings).
MISSPELT = 199
# Weight of words in one tile, and of packed groups in one index; a word weighs one per 32 letters begun.
TILE = 16_384
PACK = 2_048
# 64-bit words that one matrix of query sets may hold.
MATRIX = 1 << 16


def misspell(doc_id: Column, run: Column) -> Column:
    """The run without the letter at crc32 modulo its length, if 199 divides the crc32 of `<doc_id>:<run>`."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % MISSPELT == 0, F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)


def vocabulary(documents: DataFrame, least_letters: int = LEAST_LETTERS, least_times: int = LEAST_TIMES) -> DataFrame:
    """(word, n): the words of all texts, some misspelt by rule, that have enough letters and occurrences."""
    text = F.regexp_extract_all(F.col("text"), F.lit(LETTERS), F.lit(0))
    runs = documents.select(F.col("doc_id").alias("doc_id"), F.explode(text).alias("run"))
    runs = runs.where(F.length("run") >= least_letters).withColumn("run", F.translate("run", UPPER, UPPER.lower()))
    words = runs.select(misspell(F.col("doc_id"), F.col("run")).alias("word")).where(F.length("word") >= least_letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_times)


class PositionIndex:
    """Bitsets over words: which have a letter at a position, and which have a number of letters.

    `letters` holds the code points of all words one after the other, `lengths` their numbers.
    """

    def __init__(self, letters: np.ndarray, lengths: np.ndarray):
        self.width = (len(lengths) + 63) // 64
        position = np.arange(len(letters)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        self.keys, row = np.unique((position << 32) | letters, return_inverse=True)
        self.sets = self._bitsets(row, owner, len(self.keys) + 1)  # the last one is empty: letters that no word has there
        self.sizes, row = np.unique(lengths, return_inverse=True)
        self.of_size = self._bitsets(row, np.arange(len(lengths)), len(self.sizes) + 1)

    def _bitsets(self, row: np.ndarray, word: np.ndarray, n: int) -> np.ndarray:
        sets = np.zeros((n, self.width), np.uint64)
        np.bitwise_or.at(sets, (row, word >> 6), np.uint64(1) << (word & 63).astype(np.uint64))
        return sets

    def at(self, position: int, letters: np.ndarray) -> np.ndarray:
        """One bitset per letter: the words that have it at the position."""
        return self.sets[self._rows(self.keys, (position << 32) | letters)]

    def with_length(self, lengths: np.ndarray) -> np.ndarray:
        return self.of_size[self._rows(self.sizes, lengths)]

    @staticmethod
    def _rows(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        row = np.searchsorted(keys, wanted)
        found = keys[np.minimum(row, len(keys) - 1)] == wanted
        return np.where(found, row, len(keys))

    def near(self, letters: np.ndarray, lengths: np.ndarray, skip: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, word) exactly one error apart. Words whose first `skip` letters equal the query's are left out
        (0: none)."""
        first = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        rows = max(1, MATRIX // max(self.width, 1))
        for low in range(0, len(order), rows):
            own = order[low : low + rows]
            query, word = self._read(letters, first[own], lengths[own], skip[own])
            yield own[query], word

    def _read(self, letters: np.ndarray, first: np.ndarray, lengths: np.ndarray, skip: np.ndarray):
        """Read some queries, the longest first, so that those with letters left are always the first rows."""
        shape = (len(first), self.width)
        equal = np.full(shape, ~np.uint64(0))
        replaced, missing, added, left_out = (np.zeros(shape, np.uint64) for _ in range(4))
        for k in range(int(lengths[0])):
            n = int(np.searchsorted(-lengths, -k, side="left"))  # queries with more than k letters
            letter = letters[first[:n] + k]
            here, same = self.at(k, letter), equal[:n]
            # One letter more than the query so far: the additional one was before, or is the one just passed.
            added[:n] = (added[:n] | same) & self.at(k + 1, letter)
            # One letter fewer: this letter of the query is the missing one, or one before it was.
            if k:
                missing[:n] &= self.at(k - 1, letter)
            missing[:n] |= same
            replaced[:n] = (replaced[:n] & here) | (same & ~here)
            equal[:n] &= here
            ready = np.flatnonzero(skip[:n] == k + 1)
            left_out[ready] = equal[ready]
        out = (replaced & self.with_length(lengths)) | (missing & self.with_length(lengths - 1))
        out |= (added | equal) & self.with_length(lengths + 1)
        out &= ~left_out
        query, block = np.nonzero(out)
        bits = np.unpackbits(out[query, block].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        at, bit = np.nonzero(bits)
        return query[at], (block[at] << 6) + bit


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words one after the other, and their numbers of letters."""
    texts = words.to_pylist()
    lengths = np.array([len(w) for w in texts], np.int64)
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64), lengths


def _part(letters: np.ndarray, lengths: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return letters[np.repeat(chosen, lengths)], lengths[chosen]


def near_in_groups(members: pa.RecordBatch) -> pa.RecordBatch:
    """Per asking word of whole groups: word, how many near words the group's index has, the best of them and its n.

    Rows: word, n, side (0: groups by first letters, 1: by last), size (letters of the shorter words), group (a number),
    asks and listed (booleans). The best has the largest n, then the least code points.
    """
    word, n = members["word"], members["n"].to_numpy()
    side, size, group = (members[c].to_numpy() for c in ("side", "size", "group"))
    asks, listed = (members[c].to_numpy(zero_copy_only=False) for c in ("asks", "listed"))
    letters, lengths = _letters(word)
    query, entry = np.flatnonzero(asks), np.flatnonzero(listed)
    ranked = np.lexsort((np.argsort(np.argsort(word.to_numpy(zero_copy_only=False))), -n))
    rank = np.empty(len(ranked), np.int64)
    rank[ranked] = np.arange(len(ranked))
    pairs = []
    if len(query) and len(entry):
        index = PositionIndex(*_part(letters, lengths, listed))
        # Words that also share their first letters are found by them.
        skip = np.where(side == 1, size // 2, 0)[query]
        for q, w in index.near(*_part(letters, lengths, asks), skip):
            q, w = query[q], entry[w]
            own = (group[q] == group[w]) & (np.minimum(lengths[q], lengths[w]) == size[q])
            pairs.append(np.stack([q[own], w[own]]))
    q, w = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
    order = np.lexsort((rank[w], q))
    q, w = q[order], w[order]
    owner, at, count = np.unique(q, return_index=True, return_counts=True)
    best = w[at]
    columns = [word.take(pa.array(owner)), pa.array(count, pa.int64()), word.take(pa.array(best)), pa.array(n[best])]
    return pa.RecordBatch.from_arrays(columns, ["word", "n_near", "form", "form_n"])


def _members(words: DataFrame) -> DataFrame:
    """Each word in the groups where it can meet near words: by first and by last letters, as one of the shorter words
    (size: its letters) and as one of the longer (size: one less)."""
    n = F.length("word")
    entries = [
        F.struct(
            F.lit(side).alias("side"),
            (n - less).alias("size"),
            F.substr("word", F.lit(1), half) .alias("key") if side == 0 else F.substr("word", n - half + 1).alias("key"),
        )
        for side in (0, 1)
        for less in (0, 1)
        for half in [F.floor((n - less) / 2).cast("int")]
    ]
    weight = F.ceil(n / 32).cast("long").alias("weight")
    return words.select("word", "n", weight, F.explode(F.array(*entries)).alias("m")).select("word", "n", "weight", "m.*")


def _tiled(members: DataFrame, tile: int) -> DataFrame:
    """Members with the tiles where they ask and where they are listed. A group of more than one tile's weight is dealt
    out by hash; a word then asks in a row of tiles and is listed in a column of tiles."""
    key = ["side", "size", "key"]
    total = members.groupBy(*key).agg(F.sum("weight").alias("total"), F.count("*").alias("others"))
    # A group of one word has no near words.
    total = total.where("others > 1").select(*key, F.ceil(F.col("total") / tile).cast("int").alias("tiles"))
    own = members.join(total, key).withColumn("own", F.pmod(F.xxhash64("word", "size"), F.col("tiles")).cast("int"))
    each = F.sequence(F.lit(0), F.col("tiles") - 1)
    asking = F.transform(each, lambda t: F.struct(F.col("own").alias("row"), t.alias("column"), F.lit(True).alias("asks"), (t == F.col("own")).alias("listed")))
    listing = F.transform(
        F.filter(each, lambda t: t != F.col("own")),
        lambda t: F.struct(t.alias("row"), F.col("own").alias("column"), F.lit(False).alias("asks"), F.lit(True).alias("listed")),
    )
    return own.select("word", "n", "weight", *key, F.explode(F.concat(asking, listing)).alias("t")).select(
        "word", "n", "weight", *key, "t.*"
    )


_GROUP = ["side", "size", "key", "row", "column"]


def near_words(words: DataFrame, tile: int = TILE, pack: int = PACK) -> DataFrame:
    """(word, n_near, form, form_n) for the words (word, n) that have near words: how many, and the one of largest n (then
    the least code points)."""
    ship_package()
    dealt = _tiled(_members(words), tile)
    ordered = dealt.repartition(*_GROUP).sortWithinPartitions(*_GROUP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _whole_groups(batches, pack):
            yield near_in_groups(held)

    found = ordered.mapInArrow(run, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form"))).alias("best")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def _whole_groups(batches: Iterator[pa.RecordBatch], pack: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group as pieces of whole groups: about `pack` weight, or one group if that is heavier."""
    held: list[pa.Table] = []

    def pieces(rows: pa.Table, last: bool) -> Iterator[pa.RecordBatch]:
        """All whole groups of the rows; the last group may go on and is kept back."""
        columns = [rows[c].combine_chunks() for c in _GROUP]
        new = np.ones(len(rows), bool)
        new[1:] = False
        for c in columns:
            new[1:] |= c.slice(1).to_numpy(zero_copy_only=False) != c.slice(0, len(c) - 1).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(new)
        rows = rows.append_column("group", pa.array(np.cumsum(new)))
        ends = np.append(starts[1:], len(rows))
        whole = len(starts) if last else len(starts) - 1
        weight = np.concatenate([[0], np.cumsum(rows["weight"].to_numpy())])
        k = 0
        while k < whole:
            end = int(np.searchsorted(weight[ends[:whole]], weight[starts[k]] + pack, side="right"))
            end = max(end, k + 1)
            yield rows.slice(starts[k], ends[end - 1] - starts[k]).combine_chunks().to_batches()[0]
            k = end
        held[:] = [] if last else [rows.slice(starts[-1]).drop_columns("group")]

    size = 0
    for batch in batches:
        if len(batch):
            held.append(pa.Table.from_batches([batch]))
            size += len(batch)
            # A large group comes in many batches; looking at it again only when it has doubled keeps this linear.
            if size >= 2 * len(held[0]):
                yield from pieces(pa.concat_tables(held), False)
                size = sum(map(len, held))
    if held:
        yield from pieces(pa.concat_tables(held), True)


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the words (word, form) that have a form: follow forms to the last by doubling the steps.

    A form has several times its variant's occurrences, so chains are short and end.
    """
    roots = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        step = materialize(roots.join(onward, "root", "left"), "spelling-roots")
        if step.where("onward is not null").isEmpty():
            return roots
        roots = step.select("word", F.coalesce("onward", "root").alias("root"))


def spelling_groups(
    documents: DataFrame, least_letters: int = LEAST_LETTERS, least_times: int = LEAST_TIMES, ratio: int = RATIO
) -> DataFrame:
    """Per word: word, n (occurrences), n_near (near words), form, form_n, root.

    Words are runs of Latin letters of all texts, A-Z in lower case, of at least `least_letters` letters and `least_times`
    occurrences; one run in 199, chosen by the hash of doc_id and run, loses a letter. Near words differ by one inserted,
    deleted or replaced letter. The form is the near word with most occurrences (ties: least code points) if it has `ratio`
    times the word's, else null; the root is the last form reached, the word itself if it has none.

    Null and empty texts have no words; a missing doc_id is hashed as `null`. Repeated rows count again. Words and texts
    of any length are taken as they are. No rows, or no words, give no rows. Other columns are not looked at.
    """
    if least_letters < 2:
        raise ValueError("Words of one letter have no half to be grouped by")
    words = materialize(vocabulary(documents, least_letters, least_times), "spelling-words")
    near = materialize(near_words(words), "spelling-near")
    chosen = near.join(words, "word").where(F.col("form_n") >= ratio * F.col("n"))
    forms = materialize(chosen.select("word", "form", "form_n"), "spelling-forms")
    return (
        words.join(near.select("word", "n_near"), "word", "left")
        .join(forms, "word", "left")
        .join(_roots(forms), "word", "left")
        .select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            "form",
            "form_n",
            F.coalesce("root", "word").alias("root"),
        )
    )
