"""Bounded samples of labelled documents for fitting the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(column: str, modulus: int) -> Column:
    """crc32 of an id written as text, modulo ``modulus``."""
    return F.crc32(F.col(column).cast("string")) % modulus


def labelled_rows(documents: DataFrame, labels: DataFrame, target: str, modulus: int, held_out: int, rows_per_class: int, seed: int) -> DataFrame:
    """Rows doc_id, text (whole; empty for null) and label (0 or 1): at most ``rows_per_class`` training documents of each class.

    Rows whose crc fold is ``held_out`` never take part.  Repeated labels of a
    document count as their maximum, and of repeated documents the least text;
    null ids, and labels other than 0 and 1, are left out.  The documents
    are drawn by a seeded hash of the id, among those that exist.
    """
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(target).isin(0, 1) & (fold("doc_id", modulus) != held_out))
        .groupBy("doc_id")
        .agg(F.max(target).cast("int").alias("label"))
    )
    there = chosen.join(documents.select("doc_id"), "doc_id", "left_semi")
    by_hash = F.xxhash64("doc_id", F.lit(seed))
    ids = [there.filter(F.col("label") == k).orderBy(by_hash).limit(rows_per_class) for k in (0, 1)]
    # at most 2 * rows_per_class ids: the broadcast has that fixed bound
    sample = documents.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(ids[0].unionByName(ids[1])), "doc_id")
    return sample.groupBy("doc_id", "label").agg(F.coalesce(F.min("text"), F.lit("")).alias("text"))
