"""Quality classifier: attention-based multiple-instance learning over the passages of a document.

Every passage of a text is encoded; gated attention, learned from document labels alone, weighs the passages, and
the weighted sum is scored. The model is fitted on a bounded sample of labelled documents and applied to whole texts.
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
from msgflow.session import ship_package

PASSAGE = 48  # words
PER_CLASS = 3000  # labelled documents of each class that the model is fitted on, at most
WORD_DIMENSIONS = 32
HELD_OUT = 1
DIVISOR = 3

# Kinds of bytes whose share in a passage is a feature.
_KINDS = (
    range(65, 91), range(97, 123), range(48, 58), range(128, 256), b"!", b"|", b"#$%&*", b".", b",", b"?;:", b"'\"`",
    b"<>{}[]()", b"=+-_~^", b"/\\@", b"\n", b"\r\t\v\f",
)
_KIND = np.full(256, len(_KINDS), np.int64)
for _number, _kind in enumerate(_KINDS):
    _KIND[list(_kind)] = _number


def encode(texts: pa.Array, passage: int = PASSAGE) -> Iterator[tuple[W.Slice, np.ndarray, np.ndarray]]:
    """Slices of documents with the features of their passages and the passages' documents.

    A passage is `passage` words, the last of a text what is left; a text without words is one empty passage.
    """
    hasher = W.Hasher()
    for part in W.slices(texts):
        hashes = hasher.words(part)
        counts = part.counts()
        pieces = np.maximum(-(-counts // passage), 1)
        bag = np.repeat(np.arange(part.size), pieces)
        within = np.arange(len(bag)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        low = part.first[bag] + within * passage
        high = np.minimum(low + passage, part.first[bag + 1])
        n = high - low
        home = np.repeat(np.arange(len(bag)), n)  # each word's passage

        # Bytes from the passage's first word to the next passage's, so white space between words counts.
        begin = np.where(n > 0, part.starts[np.minimum(low, len(part.starts) - 1)], 0) if len(part.starts) else np.zeros(len(bag), np.int64)
        end = np.where(n > 0, part.ends[np.maximum(high - 1, 0)], 0) if len(part.starts) else begin
        length = np.maximum(end - begin, 0)
        kinds = np.empty((len(bag), len(_KINDS)), np.float32)
        kind = _KIND[part.data]
        for number in range(len(_KINDS)):
            total = np.concatenate([[0], np.cumsum(kind == number)])
            kinds[:, number] = total[end] - total[begin]
        kinds /= np.maximum(length, 1)[:, None]

        size = np.maximum(n, 1).astype(np.float32)
        _, owner = W.distinct(hashes, home)
        variety = np.bincount(owner, minlength=len(bag)) / size
        again = np.zeros(len(hashes), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (home[1:] == home[:-1])
        long = part.ends - part.starts
        tail = part.data[part.ends - 1] if len(part.ends) else np.zeros(0, np.uint8)
        odd = ~np.isin(_KIND[tail], (0, 1, 2, 3, 7, 8, 9))
        shout = np.isin(_KIND[part.data[part.starts]], (0,)) & np.isin(_KIND[part.data[np.maximum(part.ends - 2, part.starts)]], (0, 4)) if len(part.ends) else np.zeros(0, bool)

        def share(x: np.ndarray) -> np.ndarray:
            return np.bincount(home, x, minlength=len(bag)) / size

        spread = np.bincount(
            home * WORD_DIMENSIONS + (hashes >> np.uint64(59)).astype(np.int64), minlength=len(bag) * WORD_DIMENSIONS
        ).reshape(len(bag), WORD_DIMENSIONS) / size[:, None]
        own = np.stack(
            [variety, share(again), share(odd), share(shout), share(long <= 3), share(long) / 8, np.log1p(n) / 4], axis=1
        )
        yield part, np.concatenate([kinds, own, spread], axis=1, dtype=np.float32), bag


@dataclass
class Model:
    """Standardised features -> tanh encoding -> gated attention -> logistic score."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def score(self, features: np.ndarray, bag: np.ndarray, size: int) -> np.ndarray:
        return 1 / (1 + np.exp(-_forward(self.weights, (features - self.mean) / self.scale, bag, size)["logit"]))


def _sums(x: np.ndarray, bag: np.ndarray, size: int) -> np.ndarray:
    """Sums of rows by bag; bags are in order and none is empty."""
    return np.add.reduceat(x, np.searchsorted(bag, np.arange(size)), axis=0)


def _forward(w: dict[str, np.ndarray], x: np.ndarray, bag: np.ndarray, size: int) -> dict[str, np.ndarray]:
    h = np.tanh(x @ w["encode"] + w["shift"])
    look, gate = np.tanh(h @ w["look"]), 1 / (1 + np.exp(-(h @ w["gate"])))
    raw = (look * gate) @ w["attend"]
    raw = raw - np.maximum.reduceat(raw, np.searchsorted(bag, np.arange(size)))[bag]
    weight = np.exp(raw)
    weight /= _sums(weight, bag, size)[bag]
    z = _sums(weight[:, None] * h, bag, size)
    return {"h": h, "look": look, "gate": gate, "weight": weight, "z": z, "logit": z @ w["out"] + w["bias"]}


def _gradients(w: dict, x: np.ndarray, bag: np.ndarray, size: int, label: np.ndarray, decay: float) -> dict:
    f = _forward(w, x, bag, size)
    d_logit = (1 / (1 + np.exp(-f["logit"])) - label) / size
    d_z = d_logit[:, None] * w["out"]
    along = (d_z[bag] * f["h"]).sum(axis=1)
    d_raw = f["weight"] * (along - _sums(f["weight"] * along, bag, size)[bag])
    d_both = d_raw[:, None] * w["attend"]
    d_look = d_both * f["gate"] * (1 - f["look"] ** 2)
    d_gate = d_both * f["look"] * f["gate"] * (1 - f["gate"])
    d_h = f["weight"][:, None] * d_z[bag] + d_look @ w["look"].T + d_gate @ w["gate"].T
    d_in = d_h * (1 - f["h"] ** 2)
    found = {
        "encode": x.T @ d_in, "shift": d_in.sum(axis=0), "look": f["h"].T @ d_look, "gate": f["h"].T @ d_gate,
        "attend": (f["look"] * f["gate"]).T @ d_raw, "out": f["z"].T @ d_logit, "bias": d_logit.sum(keepdims=True),
    }
    return {k: v + decay * w[k] for k, v in found.items()}


def train(
    features: np.ndarray, bag: np.ndarray, labels: np.ndarray, seed: int = 7, epochs: int = 30, batch: int = 128,
    hidden: int = 24, attention: int = 12, rate: float = 0.01, decay: float = 1e-4,
) -> Model:
    """Adam over batches of documents. `bag` numbers the documents of the rows from 0, in order."""
    random = np.random.default_rng(seed)
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-3
    x = ((features - mean) / scale).astype(np.float32)
    shapes = {"encode": (x.shape[1], hidden), "look": (hidden, attention), "gate": (hidden, attention)}
    w = {k: random.normal(0, shape[0] ** -0.5, shape).astype(np.float32) for k, shape in shapes.items()}
    w |= {"attend": random.normal(0, attention**-0.5, attention), "out": random.normal(0, hidden**-0.5, hidden)}
    w |= {"shift": np.zeros(hidden), "bias": np.zeros(1)}
    w = {k: v.astype(np.float32) for k, v in w.items()}
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    starts = np.searchsorted(bag, np.arange(len(labels) + 1))
    step = 0
    for _ in range(epochs):
        order = random.permutation(len(labels))
        for low in range(0, len(order), batch):
            chosen = order[low : low + batch]
            n = starts[chosen + 1] - starts[chosen]
            rows = np.repeat(starts[chosen] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            grad = _gradients(w, x[rows], np.repeat(np.arange(len(chosen)), n), len(chosen), labels[chosen], decay)
            step += 1
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                w[k] = w[k] - (rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return Model(mean, scale, w)


def fit(documents: DataFrame, labels: DataFrame, allowed: Column, per_class: int = PER_CLASS) -> Model | float:
    """A model fitted on at most 2 * per_class labelled documents with all their passages; where one class is missing, the
    constant score."""
    ship_package()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, features, bag in encode(batch["text"]):
                for d in range(part.size):
                    low, high = np.searchsorted(bag, [d, d + 1])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch["doc_id"].slice(part.row + d, 1),
                            batch["label"].slice(part.row + d, 1),
                            pa.array([features[low:high].astype(np.float32).tobytes()], pa.binary()),
                        ],
                        ["doc_id", "label", "passages"],
                    )

    drawn = sample(documents, labels, "quality", allowed, per_class, seed=1)
    table = drawn.mapInArrow(run, "doc_id long, label int, passages binary").toArrow().sort_by("doc_id")
    label = table["label"].to_numpy().astype(np.float32)
    if len(set(label)) < 2:
        return float(label.mean()) if len(label) else 0.5
    sets = [np.frombuffer(x.as_py(), np.float32).reshape(-1, len(_KINDS) + 7 + WORD_DIMENSIONS) for x in table["passages"]]
    return train(np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets]), label)


def score(documents: DataFrame, model: Model | float) -> DataFrame:
    """(doc_id, score) of every row, from the whole text. Null and empty texts are one empty passage."""
    ship_package()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, features, bag in encode(batch["text"]):
                found = np.full(part.size, model) if isinstance(model, float) else model.score(features, bag, part.size)
                ids = batch["doc_id"].slice(part.row, part.size)
                yield pa.RecordBatch.from_arrays([ids, pa.array(found, pa.float64())], ["doc_id", "score"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def quality_report(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """Per row of documents: doc_id, held_out, score, predicted.

    Labels are learned from rows whose crc32(doc_id) mod 3 is not 1. A row without doc_id is not held out. Labels
    that are null or of another value are not learned; without both classes the score is the share of good documents, or
    0.5 without labels. Repeated rows get equal scores. No rows give no rows.
    """
    left = remainder(F.col("doc_id"), DIVISOR)
    scored = score(documents, fit(documents, labels, left != HELD_OUT, per_class))
    return scored.select(
        "doc_id",
        F.coalesce(left == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
