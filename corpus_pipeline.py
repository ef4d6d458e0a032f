"""A corpus pipeline over documents: five stages, each one operator of threadpulse.llm.

Every stage gets all rows that the one before it kept, as a table read from Parquet. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadpulse.llm import bottom_k, folders, merge_bpe, queries, rule_ledger, secret_structure, winnowing

#: Words that a Python worker keeps encoded. Workers stay for the next stages, so they take less than alone.
WORD_TABLES = 100_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that satisfy the current policy of quality rules."""
    return rule_ledger.accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id.

    Rows that repeat a doc_id and its text stay once; all texts of a doc_id that stays do. Rows with a NULL doc_id
    stay.
    """
    kept = bottom_k.near_duplicates(docs).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    once = docs.join(kept, "doc_id", "left_semi").select(docs.columns).dropDuplicates(["doc_id", "text"])
    return once.unionByName(docs.where("doc_id IS NULL"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word in a window of a benchmark item."""
    found = winnowing.overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("contaminated")
    leaks = found.select(F.col("doc_id").alias("leak_id"), F.col("text_hash").alias("leak_hash"))
    same = docs["doc_id"].eqNullSafe(leaks["leak_id"]) & (F.xxhash64(docs["text"]) == leaks["leak_hash"])
    return docs.join(leaks, same, "left_anti")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in the text replaced by their kind; n_chars follows the text."""
    clean = secret_structure.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of all documents."""
    return merge_bpe.digests(docs, queries.PIECE_MODEL, WORD_TABLES)


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scan", secrets),
    ("sentencepiece encoding", encoding),
]

#: The last stage encodes with a vocabulary file, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over documents."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = folders.written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
