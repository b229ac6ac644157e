"""Bounded samples of labelled documents, shared by the two classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, train: Column, limit: int) -> DataFrame:
    """(text, y) of at most ``limit`` labelled documents for which ``train`` (on doc_id) holds.

    The rows are drawn by the hash of their id, so the draw is the same for any
    partitioning.  A document with several label rows takes the largest label, an
    id with several texts its least one, so rows are bounded as documents are;
    null labels and labels other than 0 and 1 are left out.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    known = rows.where(F.col("y").isin(0, 1) & train).groupBy("doc_id").agg(F.max("y").alias("y"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    drawn = known.join(ids, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = texts.join(F.broadcast(drawn), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))
    return found.select("text", "y")
