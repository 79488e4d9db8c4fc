"""Toxicity by weak supervision.

1. Words and word beginnings that toxic documents hold, or repeat, more often are counted over a bounded labelled sample.
   In each fold of the sample a lexicon is chosen greedily: the term that covers most toxic documents not yet covered
   comes next. A term is a word or beginning that a document holds at least once, twice or three times.
2. Voters look at every document: the folds' lexicons, a list of common insults, and patterns of writing. Their votes
   are counted by combination over all documents.
3. A generative label model (EM over the combinations) estimates each voter's accuracy and the correlations of
   voters given the label; correlated votes count less.
4. A linear classifier over terms and patterns is trained on the posterior labels and scores whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow.llm import words as W
from msgflow.llm.labelled import remainder, sample
from msgflow.llm.tables import materialize
from msgflow.session import ship_package

PER_CLASS = 6000  # labelled documents of each class that lexicons are mined from and the classifier is fitted on
CANDIDATES = 8000  # counted terms that a lexicon may be chosen from, the most frequent in toxic documents first
PREFIXES = (4, 5, 6, 7, 8)  # bytes of a word's beginning
TIMES = 3  # up to so many occurrences make terms of their own; they are the low two bits of a term
FOLDS = 3
LEAST_DOCUMENTS = 3  # toxic documents that a term must add to a lexicon's cover
LEAST_ODDS = 8.0  # how much more often a toxic document must hold it
HELD_OUT = 0
DIVISOR = 5
PATTERNS = 3  # shares of words in capitals, of exclamation and question marks, of words of address
DEPENDENT = 0.25  # correlation given the label from which on voters count as dependent; less is the estimate's own error
TRUST = np.log(0.95 / 0.05)  # of a label, as one more voter of the documents the classifier is fitted on

# Common insults and words of address.
INSULTS = (
    "idiot", "idiots", "moron", "morons", "stupid", "dumb", "loser", "losers", "scum", "trash", "worthless", "pathetic",
    "disgusting", "clown", "vermin", "filth", "imbecile", "bastard", "degenerate", "parasite",
)
ADDRESS = ("you", "your", "youre", "du", "dich", "dein", "tu", "toi", "ton", "te", "tus")


class Lookup:
    """Numbers of known hashes; a table of bits turns most others away."""

    def __init__(self, known: np.ndarray) -> None:
        self.order = np.argsort(known)
        self.known = known[self.order]
        self.bits = np.zeros(1 << 18, bool)
        self.bits[self._low(known)] = True

    @staticmethod
    def _low(hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64((1 << 18) - 1)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the known among the hashes, and their numbers."""
        at = np.flatnonzero(self.bits[self._low(hashes)])
        place = np.searchsorted(self.known, hashes[at])
        hit = place < len(self.known)
        hit[hit] = self.known[place[hit]] == hashes[at[hit]]
        return at[hit], self.order[place[hit]]


def term_hashes(part: W.Slice, hasher: W.Hasher) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of all lower-case words, then of the beginnings of longer words, each with the numbers of their words."""
    sums = hasher.sums(W.LOWER[part.data])
    yield hasher.spans(sums, part.starts, part.ends), np.arange(len(part.starts))
    for k in PREFIXES:
        longer = np.flatnonzero(part.ends - part.starts > k)
        yield W.mix64(hasher.spans(sums, part.starts[longer], part.starts[longer] + k) + np.uint64(k)), longer


_BASE = ~np.uint64(3)


def counted(hashes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms of documents, each once, from the hashes of all occurrences of words and beginnings."""
    base = hashes & _BASE
    order = np.argsort(base)
    order = order[np.argsort(owners[order], kind="stable")]
    base, owners = base[order], owners[order]
    new = np.ones(len(base), bool)
    new[1:] = (base[1:] != base[:-1]) | (owners[1:] != owners[:-1])
    starts = np.flatnonzero(new)
    times = np.minimum(np.diff(np.append(starts, len(base))), TIMES)
    which = np.repeat(starts, times)
    step = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + 1
    return base[which] | step.astype(np.uint64), owners[which]


def _word_list(texts: tuple[str, ...]) -> np.ndarray:
    """The words as terms held once."""
    hasher = W.Hasher()
    found = [next(term_hashes(part, hasher))[0] for part in W.slices(pa.array(texts), W.NOT_LETTER)]
    return np.concatenate(found) & _BASE | np.uint64(1)


def look(texts: pa.Array, known: np.ndarray) -> Iterator[tuple[W.Slice, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of documents with the known terms they hold (numbers, and documents in order) and their patterns."""
    hasher, address = W.Hasher(), Lookup(_word_list(ADDRESS) & _BASE)
    lookup, bases = Lookup(known), np.unique(known & _BASE)
    looked = Lookup(bases)
    for part in W.slices(texts, W.NOT_LETTER):
        owners = part.owners()
        held, documents, addressed = [], [], None
        for hashes, word in term_hashes(part, hasher):
            hashes = hashes & _BASE
            if addressed is None:
                addressed = owners[address.find(hashes)[0]]
            at, number = looked.find(hashes)
            held.append(bases[number])
            documents.append(owners[word[at]])
        term, document = counted(np.concatenate(held), np.concatenate(documents))
        at, number = lookup.find(term)
        document = document[at]

        capital = np.concatenate([[0], np.cumsum((part.data >= 65) & (part.data < 91))])
        shouted = (capital[part.ends] - capital[part.starts] == part.ends - part.starts) & (part.ends - part.starts > 1)
        mark = np.concatenate([[0], np.cumsum((part.data == 33) | (part.data == 63))])
        n = np.maximum(part.counts(), 1)
        shares = [
            np.bincount(owners[shouted], minlength=part.size) / n,
            np.minimum((mark[part.offsets[1:]] - mark[part.offsets[:-1]]) / n, 1),
            np.bincount(addressed, minlength=part.size) / n,
        ]
        yield part, number, document, np.stack(shares, axis=1)


@dataclass
class Model:
    """Linear classifier over the known terms and the patterns; without terms it gives the constant."""

    known: np.ndarray
    weights: np.ndarray
    bias: float
    voters: list[float]  # accuracies by the label model, for reports

    def scores(self, texts: pa.Array) -> Iterator[tuple[W.Slice, np.ndarray]]:
        for part, number, document, shares in look(texts, self.known):
            logit = self.bias + shares @ self.weights[len(self.known) :]
            logit += np.bincount(document, self.weights[number], minlength=part.size)
            yield part, 1 / (1 + np.exp(-logit))


def label_model(
    votes: np.ndarray, counts: np.ndarray, known: np.ndarray, labels: np.ndarray, prior: float, rounds: int = 40
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Generative model of votes in -1, 0, 1: (log odds of each voter's votes, voters' discounts, correlations).

    `votes` are the combinations seen with their `counts`; `known` are votes of labelled rows, which start the
    estimate and stay in it. Rounds of EM re-estimate P(vote | label) and, from the residuals of voter pairs given the label,
    their correlations; a voter's log odds are divided by one plus its correlations with the voters it depends on.
    """
    both = np.concatenate([votes, known])
    weight = np.concatenate([counts.astype(float), np.ones(len(known))])
    posterior = np.concatenate([np.full(len(votes), np.nan), labels.astype(float)])
    free = np.isnan(posterior)
    seen = ~free
    share = prior
    discount = np.ones(votes.shape[1])
    correlation = np.eye(votes.shape[1])
    for step in range(rounds):
        use = seen if step == 0 else np.ones(len(both), bool)
        odds = np.zeros((votes.shape[1], 3))
        for v in (-1, 0, 1):
            is_v = (both[use] == v) * weight[use, None]
            toxic = ((is_v * posterior[use, None]).sum(0) + 0.5) / ((weight * posterior)[use].sum() + 1.5)
            clean = ((is_v * (1 - posterior[use, None])).sum(0) + 0.5) / ((weight * (1 - posterior))[use].sum() + 1.5)
            odds[:, v + 1] = np.log(toxic / clean)
        logit = np.log(share / (1 - share)) + log_odds(both, odds, discount)
        posterior[free] = 1 / (1 + np.exp(-logit[free]))
        if free.any():
            share = float(np.clip((weight * posterior)[free].sum() / weight[free].sum(), 1e-4, 1 - 1e-4))
        parts = []
        for given in (posterior, 1 - posterior):
            w = weight * given / max((weight * given).sum(), 1e-9)
            rest = both - (w[:, None] * both).sum(0)
            spread = np.sqrt((w[:, None] * rest**2).sum(0)) + 1e-3
            parts.append((w[:, None] * rest).T @ rest / np.outer(spread, spread))
        correlation = (parts[0] + parts[1]) / 2
        others = correlation - np.diag(np.diag(correlation))
        discount = 1 / (1 + np.where(others > DEPENDENT, others, 0).sum(0))
    return odds, discount, correlation


def log_odds(votes: np.ndarray, odds: np.ndarray, discount: np.ndarray) -> np.ndarray:
    return (odds[np.arange(votes.shape[1]), votes + 1] * discount).sum(axis=1)


def cover(held: np.ndarray, labels: np.ndarray, most: int = 400) -> list[int]:
    """Numbers of the terms of a lexicon. `held` is documents by terms; greedy, ties to the lower number."""
    toxic, clean = held[labels == 1], held[labels == 0]
    rate = (toxic.sum(0) + 0.5) / (len(toxic) + 1) / ((clean.sum(0) + 0.5) / (len(clean) + 1))
    usable = rate >= LEAST_ODDS
    # A clean document with the term takes back what three toxic ones give.
    fine = 3 * clean.sum(0)
    chosen, left = [], np.ones(len(toxic), bool)
    while len(chosen) < most:
        gain = np.where(usable, toxic[left].sum(0) - fine, 0)
        best = int(gain.argmax()) if len(gain) else 0
        if not len(gain) or gain[best] < LEAST_DOCUMENTS:
            break
        chosen.append(best)
        left &= ~toxic[:, best]
    return chosen


def train(features: np.ndarray, target: np.ndarray, rounds: int = 400, rate: float = 0.1, decay: float = 3e-4) -> np.ndarray:
    """Logistic regression on soft labels by Adam; the last weight is the bias."""
    x = np.concatenate([features, np.ones((len(features), 1), np.float32)], axis=1).astype(np.float32)
    w, first, second = (np.zeros(x.shape[1], np.float32) for _ in range(3))
    for step in range(1, rounds + 1):
        grad = x.T @ ((1 / (1 + np.exp(-(x @ w))) - target) / len(x)).astype(np.float32) + decay * w
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        w = w - rate * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w


def _looked(documents: DataFrame, known: np.ndarray, keep: str) -> DataFrame:
    """(kept columns, terms, shares) of documents."""
    names = keep.replace(",", " ").split()[::2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, document, shares in look(batch["text"], known):
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch[c].slice(part.row, part.size) for c in names),
                        W.lists(number, document, part.size, pa.int64()),
                        W.lists(shares.ravel(), np.repeat(np.arange(part.size), PATTERNS), part.size, pa.float64()),
                    ],
                    [*names, "terms", "shares"],
                )

    return documents.select(*names, "text").mapInArrow(run, f"{keep}, terms array<long>, shares array<double>")


def _counted(drawn: DataFrame) -> np.ndarray:
    """Hashes of the CANDIDATES terms that most toxic documents hold, of those more frequent there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = W.Hasher()
        for batch in batches:
            for part in W.slices(batch["text"], W.NOT_LETTER):
                owners = part.owners()
                found = [(hashes, owners[word]) for hashes, word in term_hashes(part, hasher)]
                value, owner = counted(*(np.concatenate(x) for x in zip(*found)))
                yield pa.RecordBatch.from_arrays(
                    [batch["label"].slice(part.row, part.size), W.lists(value.view(np.int64), owner, part.size, pa.int64())],
                    ["label", "terms"],
                )

    toxic, clean = (drawn.where(F.col("label") == v).count() for v in (1, 0))
    listed = drawn.select("label", "text").mapInArrow(run, "label int, terms array<long>")
    counts = listed.select("label", F.explode("terms").alias("term")).groupBy("term").agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")
    )
    odds = (F.col("toxic") + 0.5) / (toxic + 1) / ((F.col("clean") + 0.5) / (clean + 1))
    best = counts.where((F.col("toxic") >= LEAST_DOCUMENTS) & (odds >= LEAST_ODDS)).orderBy(F.desc("toxic"), "term").limit(CANDIDATES)
    return best.toArrow()["term"].to_numpy().view(np.uint64)


def fit(documents: DataFrame, labels: DataFrame, allowed: Column, per_class: int = PER_CLASS) -> Model:
    """The classifier; a constant one where the allowed labels hold one class only (0 without any)."""
    ship_package()
    drawn = materialize(sample(documents, labels, "toxic", allowed, per_class, seed=6), "toxic-sample")
    present = {r.label for r in drawn.select("label").distinct().collect()}  # at most two
    if len(present) < 2:
        return Model(np.zeros(0, np.uint64), np.zeros(PATTERNS), 6.0 if present == {1} else -6.0, [])
    prior = labels.where(F.col("toxic").isin(0, 1) & allowed).agg(F.avg("toxic")).first()[0]

    listed = np.unique(np.concatenate([_counted(drawn), _word_list(INSULTS)]))
    insults = np.isin(listed, _word_list(INSULTS))
    table = _looked(drawn, listed, "doc_id long, label int").toArrow().sort_by("doc_id")
    label = table["label"].to_numpy()
    held = np.zeros((len(label), len(listed)), bool)
    terms = table["terms"].combine_chunks()
    held[np.repeat(np.arange(len(label)), np.diff(terms.offsets.to_numpy())), terms.flatten().to_numpy()] = True
    share = table["shares"].combine_chunks().flatten().to_numpy().reshape(-1, PATTERNS)
    fold = W.mix64(table["doc_id"].to_numpy().astype(np.int64).view(np.uint64)) % np.uint64(FOLDS)
    lexicons = [np.array(cover(held[fold == k], label[fold == k]), np.int64) for k in range(FOLDS)]
    lexicons.append(np.flatnonzero(insults))
    limits = np.quantile(share[label == 0], 0.99, axis=0)

    # Only terms of a lexicon are looked for from here on.
    used = np.unique(np.concatenate(lexicons))
    lexicons = [np.searchsorted(used, x) for x in lexicons]
    known, held = listed[used], held[:, used]
    votes = np.concatenate(
        [np.stack([np.where(held[:, x].any(axis=1), 1, -1) for x in lexicons], axis=1), (share > limits).astype(np.int64)], axis=1
    )

    looked = _looked(documents, known, "doc_id long")
    voters = [
        F.when(F.arrays_overlap("terms", F.array(*[F.lit(int(t)) for t in x]).cast("array<long>")), 1).otherwise(-1)
        for x in lexicons
    ] + [(F.element_at("shares", k + 1) > float(limits[k])).cast("int") for k in range(PATTERNS)]
    names = [f"v{k}" for k in range(len(voters))]
    # At most 3 combinations per voter and voter: a few hundred rows.
    seen = looked.select(*[v.alias(n) for v, n in zip(voters, names)]).groupBy(*names).count().toArrow()
    combined = np.stack([seen[n].to_numpy() for n in names], axis=1).astype(np.int64)
    odds, discount, _ = label_model(combined, seen["count"].to_numpy(), votes, label, prior)
    logit = np.log(prior / (1 - prior)) + log_odds(votes, odds, discount) + np.where(label == 1, TRUST, -TRUST)
    weights = train(np.concatenate([held, share], axis=1), 1 / (1 + np.exp(-logit)))
    accuracy = [float(x) for x in ((votes > 0) == (label[:, None] == 1)).mean(axis=0)]
    return Model(known, weights[:-1], float(weights[-1]), accuracy)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row, from the whole text; null and empty texts hold no term."""
    ship_package()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in model.scores(batch["text"]):
                ids = batch["doc_id"].slice(part.row, part.size)
                yield pa.RecordBatch.from_arrays([ids, pa.array(found, pa.float64())], ["doc_id", "score"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def allowed(doc_id: Column) -> Column:
    """Rows that labels may be learned from."""
    return remainder(doc_id, DIVISOR) != HELD_OUT


def toxicity_report(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """Per row of documents: doc_id, held_out, score, predicted.

    Labels are learned from rows whose crc32(doc_id) mod 5 is not 0. A row without doc_id is not held out. Labels
    that are null or of another value are not learned; with one class only all scores are near it, without labels near
    0. Repeated rows get equal scores. No rows give no rows.
    """
    scored = score(documents, fit(documents, labels, allowed(F.col("doc_id")), per_class))
    return scored.select(
        "doc_id",
        F.coalesce(~allowed(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(documents: DataFrame, labels: DataFrame, limit: float = 0.5, per_class: int = PER_CLASS) -> DataFrame:
    """The documents that score below the limit; columns as given. Texts are scored where they lie, without a shuffle."""
    model = fit(documents, labels, allowed(F.col("doc_id")), per_class)

    @F.arrow_udf("double")
    def toxic(texts: pa.Array) -> pa.Array:
        parts = [found for _, found in model.scores(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    kept = documents.select(F.struct("*").alias("__row"), toxic(F.col("text")).alias("__score"))
    return kept.where(F.col("__score") < limit).select("__row.*")
