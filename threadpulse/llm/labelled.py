"""Bounded samples of labelled rows for training, and the split that keeps held-out rows apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose crc32 of the doc_id as text leaves no remainder; a NULL doc_id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, per_label: int) -> DataFrame:
    """Up to per_label documents (doc_id, text, label) for each label: those with the smallest hash of doc_id.

    Documents are distinct ids that have a text in docs and a label in labels (the largest if chosen by
    several; the smallest text if docs has several), so copies of rows and rows without text take no place.
    Ids are chosen without their texts: a row of each table is reduced to its id before the shuffle, and every
    task keeps per_label ids a label before the next, so a frequent label or id moves no more.
    """
    known = labels.where(~held_out() & F.col(label).isNotNull()).select("doc_id", label).distinct()
    with_text = docs.where("text IS NOT NULL").select("doc_id").distinct()
    order = Window.partitionBy(label).orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id")
    candidates = known.join(with_text, "doc_id", "left_semi")
    ranked = candidates.withColumn("rank", F.row_number().over(order)).where(f"rank <= {per_label}")
    chosen = F.broadcast(ranked.groupBy("doc_id").agg(F.max(label).alias(label)))  # per_label rows a label at most
    found = docs.select("doc_id", "text").where("text IS NOT NULL").join(chosen, "doc_id")
    return found.groupBy("doc_id", label).agg(F.min("text").alias("text")).select("doc_id", "text", label)
