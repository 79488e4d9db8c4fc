"""Bounded samples of labelled documents, and the split that holds rows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the doc_id as text, modulo the divisor; null for a null doc_id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def sample(
    documents: DataFrame, labels: DataFrame, column: str, allowed: Column, per_class: int, seed: int
) -> DataFrame:
    """(doc_id, text, label) of at most `per_class` documents of each label 0 and 1, chosen by a seeded hash.

    Rows of `labels` count where `allowed` holds. A doc_id with several labels has the larger, one with
    several texts the least. The chosen ids are
    broadcast: at most two times per_class rows.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1) & allowed)
    usable = usable.groupBy("doc_id").agg(F.max(column).cast("int").alias("label"))
    drawn = [
        usable.where(F.col("label") == value).orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(per_class)
        for value in (0, 1)
    ]
    found = documents.select("doc_id", "text").join(F.broadcast(drawn[0].union(drawn[1])), "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
