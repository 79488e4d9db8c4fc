"""Language identification by Bayesian evidence fusion.

For each page the text's likelihood under every language is combined with the likelihoods of the declared markup language
and of the address suffix, and with a prior of the host. Priors are smoothed along the address: host over domain over all
pages. Every table but the text model comes from grouped aggregation over all pages; the text model counts words of all
documents of a known language.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgflow.llm import words as W
from msgflow.llm.tables import materialize
from msgflow.session import ship_package

SLOTS = 1 << 16  # of hashed words and word endings, for each language
ENDING = 3  # bytes
BLOCK = 64  # languages that are scored at once: SLOTS * BLOCK numbers are held; more are scored in further passes
WORDS_THAT_COUNT = 40  # neighbouring words are not independent: a longer text speaks with so many words at most
SMOOTHING = 8.0  # pages that the next wider prior counts for
# Elements that hold no running text, and second-level names under which countries give domains.
SKIPPED = ("script", "style", "nav", "footer", "header", "aside", "template")
REGISTRIES = ("co", "com", "org", "net", "gov", "edu", "ac")
_NAMES = "|".join(SKIPPED)
_MARK = re.compile(r"<|&#?[a-z0-9]+;", re.IGNORECASE | re.ASCII)
_ENTITY = re.compile(r"&#?[a-z0-9]+;", re.IGNORECASE | re.ASCII)
_OPENS = re.compile(rf"<({_NAMES})\b", re.IGNORECASE | re.ASCII)
_CLOSES = re.compile(rf"</({_NAMES})\s*>", re.IGNORECASE | re.ASCII)


class _Ends:
    """Next place of a mark at or behind a rising place; the text is searched once, also where the mark is missing."""

    def __init__(self, text: str, mark: str):
        self.text, self.mark, self.place = text, mark, -1

    def behind(self, at: int) -> int:
        if self.place is not None and self.place < at:
            found = self.text.find(self.mark, at)
            self.place = None if found < 0 else found
        return -1 if self.place is None else self.place


def strip_markup(html: str) -> str:
    """The running text of a page: elements of SKIPPED up to their end, comments, tags and entities become a space.

    An element or comment that is not closed loses its tag only; a `<` that no `>` follows is text. Every page takes time in
    proportion to its length, whatever it leaves open.
    """
    closes: dict[str, list[tuple[int, int]]] = {}
    for m in _CLOSES.finditer(html):
        closes.setdefault(m[1].lower(), []).append(m.span())
    comment, tag = _Ends(html, "-->"), _Ends(html, ">")
    used = dict.fromkeys(closes, 0)
    out, at = [], 0
    while (mark := _MARK.search(html, at)) is not None:
        start, end = mark.span()
        if html[start] == "<":
            opens = _OPENS.match(html, start)
            name = opens[1].lower() if opens else None
            end = 0
            if name in closes:
                spans, k = closes[name], used[name]
                while k < len(spans) and spans[k][0] < opens.end():
                    k += 1
                used[name] = k
                end = spans[k][1] if k < len(spans) else 0
            elif html.startswith("<!--", start):
                end = comment.behind(start + 4) + 3 if comment.behind(start + 4) >= 0 else 0
            end = end or tag.behind(start + 1) + 1
            if not end:
                break  # nothing behind is closed any more
        out += [html[at:start], " "]
        at = end
    out.append(_ENTITY.sub(" ", html[at:]))
    return "".join(out)


def plain_text(html: Column) -> Column:
    """`strip_markup` over a column; null gives an empty text."""

    @F.arrow_udf(T.StringType())
    def strip(pages: pa.Array) -> pa.Array:
        return pa.array((strip_markup(page.as_py() or "") for page in pages), pa.string())

    return strip(html)


def host(url: Column) -> Column:
    """Host of an address in small letters: without user, password and port, with or without a scheme; empty if there is
    none. An address without `//` needs a dot in its host."""
    given = F.coalesce(url, F.lit(""))
    full = F.regexp_extract(given, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#]*@)?(\[[^\]/]*\]|[^/:?#]+)", 1)
    bare = F.regexp_extract(given, r"^(?:[^/?#@]*@)?([^/:?#@\s]+\.[^/:?#@\s]+)(?:[/:?#]|$)", 1)
    return F.lower(F.when(full != "", full).otherwise(bare))


def domain(labels: Column) -> Column:
    """The registered part of a host from its labels: the last two, or three under a country's second-level name."""
    n = F.size(labels)
    under = (n > 2) & (F.length(F.element_at(labels, -1)) == 2) & F.get(labels, n - 2).isin(*REGISTRIES)
    wanted = F.when(under, 3).otherwise(2)
    return F.array_join(F.slice(labels, F.greatest(n - wanted + 1, F.lit(1)), wanted), ".")


def declared(html: Column) -> Column:
    """Primary language of the root element's lang attribute, empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]{2,3})", 1))


def _slots(part: W.Slice, hasher: W.Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all words and endings, and the numbers of their documents."""
    sums = hasher.sums(W.LOWER[part.data])
    owners = part.owners()
    whole = hasher.spans(sums, part.starts, part.ends)
    longer = np.flatnonzero(part.ends - part.starts > ENDING)
    ends = W.mix64(hasher.spans(sums, part.ends[longer] - ENDING, part.ends[longer]) + np.uint64(ENDING))
    slots = (np.concatenate([whole, ends]) & np.uint64(SLOTS - 1)).astype(np.int64)
    return slots, np.concatenate([owners, owners[longer]])


@dataclass
class TextModel:
    """Counts of the slots by language as a table; log probabilities are made for BLOCK languages at a time."""

    languages: int
    counts: DataFrame
    base: np.ndarray  # what smoothing adds to each slot

    def block(self, first: int) -> np.ndarray:
        """Log probability of each slot by language, for the languages from `first` on."""
        size = min(BLOCK, self.languages - first)
        own = self.counts.where((F.col("language") >= first) & (F.col("language") < first + size)).toArrow()
        smooth = np.zeros((size, SLOTS))
        smooth[own["language"].to_numpy() - first, own["slot"].to_numpy()] = own["n"].to_numpy()
        smooth += self.base
        return np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32)


def text_model(documents: DataFrame) -> tuple[list[str], TextModel]:
    """(languages, model of the words of all documents with a language). The driver holds the languages' names."""
    ship_package()
    known = documents.where("lang is not null and lang != ''").select(F.lower("lang").alias("lang"), "text")
    names = [r[0] for r in known.select("lang").distinct().orderBy("lang").collect()]
    number = {name: k for k, name in enumerate(names)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            arrays = [pa.array(keys // SLOTS, pa.int64()), pa.array(keys % SLOTS, pa.int64()), pa.array(n, pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, ["language", "slot", "n"])

        hasher, keys, n = W.Hasher(), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            language = np.array([number[x] for x in batch["lang"].to_pylist()], np.int64)
            for part in W.slices(batch["text"], W.NOT_LETTER):
                slots, owners = _slots(part, hasher)
                own, own_n = np.unique(language[part.row + owners] * SLOTS + slots, return_counts=True)
                keys, place = np.unique(np.concatenate([keys, own]), return_inverse=True)
                n = np.bincount(place, np.concatenate([n, own_n]), minlength=len(keys)).astype(np.int64)
                if len(keys) > 16 * SLOTS:
                    yield rows(keys, n)
                    keys, n = keys[:0], n[:0]
        yield rows(keys, n)

    counted = known.mapInArrow(count, "language long, slot long, n long")
    table = materialize(counted.groupBy("language", "slot").agg(F.sum("n").alias("n")), "language-counts")
    by_slot = table.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # at most SLOTS rows
    totals = np.zeros(SLOTS)
    totals[by_slot["slot"].to_numpy()] = by_slot["n"].to_numpy()
    return names, TextModel(len(names), table, 0.1 * (totals + 1) / (totals.sum() + SLOTS) * SLOTS)


def _scores(read: DataFrame, model: np.ndarray, block: int) -> DataFrame:
    """The rows with the text's log likelihood by language of one block."""
    languages = model.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = W.Hasher()
        for batch in batches:
            for part in W.slices(batch["text"], W.NOT_LETTER):
                slots, owners = _slots(part, hasher)
                n = np.bincount(owners, minlength=part.size)
                scale = np.minimum(1, 2 * WORDS_THAT_COUNT / np.maximum(n, 1))
                found = [np.bincount(owners, model[slots, k], minlength=part.size) * scale for k in range(languages)]
                rows = np.stack(found, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch[c].slice(part.row, part.size) for c in ("row", "page_id", "host", "declared")),
                        pa.array(part.counts(), pa.int64()),
                        pa.array(np.full(part.size, block), pa.int64()),
                        W.lists(rows.ravel(), np.repeat(np.arange(part.size), languages), part.size, pa.float64()),
                    ],
                    ["row", "page_id", "host", "declared", "n_words", "block", "scores"],
                )

    return read.mapInArrow(
        run, "row long, page_id long, host string, declared string, n_words long, block long, scores array<double>"
    )


def evidence(pages: DataFrame, model: TextModel) -> DataFrame:
    """page_id, host, domain, suffix, declared, and the text's log likelihood by language (zeros without words).

    Pages are read once for every BLOCK languages; with more than one block their rows are numbered and put together again.
    """
    firsts = range(0, model.languages, BLOCK)
    read = pages.select(
        "page_id", host(F.col("url")).alias("host"), declared(F.col("html")).alias("declared"), plain_text(F.col("html")).alias("text")
    )
    several = len(firsts) > 1
    read = read.withColumn("row", F.monotonically_increasing_id() if several else F.lit(0).cast("long"))
    if several:
        read = materialize(read, "language-texts")
    blocks = [_scores(read, model.block(first), first) for first in firsts]
    scored = blocks[0].withColumnRenamed("scores", "raw")
    if several:
        whole = blocks[0]
        for block in blocks[1:]:
            whole = whole.union(block)
        same = [F.first(c).alias(c) for c in ("page_id", "host", "declared", "n_words")]
        listed = F.sort_array(F.collect_list(F.struct("block", "scores")))
        scored = whole.groupBy("row").agg(*same, F.flatten(listed["scores"]).alias("raw"))
    scored = scored.withColumn("most", F.array_max("raw")).select(
        "page_id", "host", "declared", "n_words", F.transform("raw", lambda x: x - F.col("most")).alias("likelihood")
    )
    labels = F.split("host", r"\.")
    return scored.withColumns({
        "domain": domain(labels),
        "suffix": F.element_at(labels, -1),
    })


def identify(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """Per row of pages: page_id, lang, confidence (posterior of lang), text_lang (by the text alone), declared_lang, host.

    A page without words in its html has no text_lang and is judged by the other evidence; a missing address, host or
    declared language is a value of its own, seen like any other. Repeated rows get equal results. Without documents of a known
    language, lang and confidence are null. No pages give no rows. Ties go to the language first in code-point order.
    """
    names, model = text_model(documents)
    if not names:
        nothing = F.lit(None).cast("string")
        return pages.select(
            "page_id", nothing.alias("lang"), F.lit(None).cast("double").alias("confidence"), nothing.alias("text_lang"),
            F.nullif(declared(F.col("html")), F.lit("")).alias("declared_lang"), host(F.col("url")).alias("host"),
        )
    best = F.when(F.col("n_words") > 0, F.array_position("likelihood", F.array_max("likelihood")).cast("int") - 1)
    read = materialize(evidence(pages, model).withColumn("text_number", best), "language-pages")
    last = len(names) - 1

    def counts(by: str) -> DataFrame:
        """How many pages of each value the text alone gives to each language; one row per value, summed map-side."""
        summed = read.groupBy(by, "text_number").agg(F.count("text_number").alias("n"))
        known = F.map_from_entries(F.collect_list(F.when(F.col("text_number").isNotNull(), F.struct("text_number", "n"))))
        one = summed.groupBy(by).agg(known.alias("known"), F.sum("n").alias(f"{by}_all"))
        dense = F.transform(F.sequence(F.lit(0), F.lit(last)), lambda k: F.coalesce(F.try_element_at("known", k), F.lit(0)))
        return one.select(by, f"{by}_all", dense.alias(f"{by}_n"))

    seen_by_number = {r[0]: r[1] for r in read.where("text_number is not null").groupBy("text_number").count().collect()}
    total = F.from_json(F.lit(json.dumps([seen_by_number.get(k, 0) for k in range(len(names))])), "array<long>")
    joined = read
    for by in ("host", "domain", "suffix", "declared"):
        joined = joined.join(counts(by), by)
    seen = float(sum(seen_by_number.values()))

    def others(by: str, k: Column) -> Column:
        """Pages of the same value that the text gives to language k, without this one."""
        return F.get(f"{by}_n", k) - F.coalesce((F.col("text_number") == k).cast("long"), F.lit(0))

    def all_others(by: str) -> Column:
        return F.col(f"{by}_all") - F.col("text_number").isNotNull().cast("long")

    def log(likelihood: Column, k: Column) -> Column:
        everywhere = (F.get(total, k) + 1.0) / (seen + len(names))
        domain = (others("domain", k) + SMOOTHING * everywhere) / (all_others("domain") + SMOOTHING)
        prior = (others("host", k) + SMOOTHING * domain) / (all_others("host") + SMOOTHING)
        out = likelihood + F.log(prior)
        for by in ("suffix", "declared"):
            # P(value | language), smoothed towards the value's share of all pages.
            share = (all_others(by) + 1) / (seen + 1)
            out += F.log((others(by, k) + SMOOTHING * share) / (F.get(total, k) + SMOOTHING))
        return out

    kept = joined.select("page_id", "host", "declared", "text_number", F.transform("likelihood", log).alias("logs"))
    top = kept.withColumn("top", F.array_max("logs"))
    number = F.array_position("logs", F.col("top")).cast("int") - 1
    listed = F.from_json(F.lit(json.dumps(names)), "array<string>")
    weight = F.aggregate("logs", F.lit(0.0), lambda sum_, x: sum_ + F.exp(x - F.col("top")))
    return top.select(
        "page_id",
        F.get(listed, number).alias("lang"),
        (1 / weight).alias("confidence"),
        F.get(listed, F.col("text_number")).alias("text_lang"),
        F.nullif(F.col("declared"), F.lit("")).alias("declared_lang"),
        "host",
    )
