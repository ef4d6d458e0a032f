"""The registered queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadpulse.llm import (
    bottom_k,
    cover_dedup,
    edit_lattice,
    folders,
    html_trees,
    level_products,
    merge_bpe,
    quotient_dedup,
    range_coder,
    rule_ledger,
    secret_structure,
    segment_language,
    string_kernel,
    winnowing,
)

END_ID = 2
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers import this package; on a cluster it is installed or sent with --py-files
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_trees.main_text(table(spark, sf_dir, "pages"))


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cover_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rule_ledger.ledger(table(spark, sf_dir, "documents"))
    base_failed = found["failed"].bitwiseAND(F.lit(rule_ledger.BASE)) != 0
    return found.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & rule_ledger.passes()).alias("kept"),
    )


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folders.shared_folder(spark, "token-blocks")
    range_coder.write(table(spark, sf_dir, "documents"), path, WORD_TOKENIZER, END_ID)
    return range_coder.positions(range_coder.read(spark, path))


def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottom_k.near_duplicates(table(spark, sf_dir, "documents"))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_language.predict(table(spark, sf_dir, "documents"), PIECE_MODEL)


def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_bpe.digests(table(spark, sf_dir, "documents"), PIECE_MODEL)


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return string_kernel.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_structure.scan(table(spark, sf_dir, "documents")).drop("n_spans")


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotient_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return level_products.audit(table(spark, sf_dir, "documents"))


def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = edit_lattice.damaged(table(spark, sf_dir, "conversations"))
    return edit_lattice.audits(edit_lattice.repaired(rows, present="present"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_html_extraction": html_extraction,
        "op2_substring_dedup": substring_dedup,
        "op3_quality_rules": quality_rules,
        "op4_benchmark_decontamination": benchmark_decontamination,
        "op5_token_output": token_output,
        "op6_minhash_near_dedup": minhash_near_dedup,
        "op7_language_id": language_id,
        "op8_sentencepiece": sentencepiece,
        "op9_toxicity": toxicity,
        "op10_secret_scan": secret_scan,
        "op11_exact_dedup": exact_dedup,
        "op12_source_divergence": source_divergence,
        "op13_conversation_repair": conversation_repair,
    }
