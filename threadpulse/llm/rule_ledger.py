"""Quality rules as a ledger: every rule is evaluated once and stored as a bit beside the measurements.

A policy is a versioned mask of rules. Applying another policy, or asking what a rule alone would reject,
reads the stored bits and never the texts.

Defined results: a NULL or empty text has no words and fails the word count. Rows are independent, so
repeated rows give repeated results and a NULL doc_id stays NULL. An empty table gives an empty ledger.
Columns of the input other than doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadpulse.llm import words as W

SYMBOLS = b"#*$%&|<>"
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_letters", "n_capitals", "n_exclamations",
)

#: Bit, name and SQL condition under which a document fails. Bits are never given to another rule.
RULES = (
    (0, "few_words", "n_words < 50"),
    (1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    (2, "symbols", "10 * n_symbols > n_words"),
    (3, "repeated_lines", "2 * n_dup_lines > n_lines"),
    (4, "word_length", "word_chars < 2 * n_words OR word_chars > 14 * n_words"),
    (5, "capitals", "2 * n_capitals > n_letters"),
    (6, "exclamations", "5 * n_exclamations > n_words"),
)
BIT = {name: 1 << bit for bit, name, _ in RULES}
BASE = BIT["few_words"] | BIT["repeated_words"]
#: Versioned policies: the mask of rules that reject.
POLICIES = {
    1: BASE,
    2: BASE | BIT["symbols"] | BIT["repeated_lines"] | BIT["word_length"] | BIT["capitals"] | BIT["exclamations"],
}
CURRENT = 2


def _repeated(key: np.ndarray) -> np.ndarray:
    """Whether a key occurs more than once."""
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    return count[inverse] > 1


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns of the input with the measurements as a last column."""
    for batch in W.slices(batches, "text"):
        texts = W.Texts.of(batch.column("text"))
        n, data = batch.num_rows, texts.data
        found = W.split(texts, W.WHITE)
        salt = W.mix(found.text.astype(np.uint64))
        triple = W.windows(W.hashes(texts, found), 3)
        at = np.flatnonzero(W.same_text(found, 3))
        twice = at[_repeated(triple[at] + salt[at])]
        covered = np.zeros(len(found.start) + 1, bool)
        for k in range(3):
            covered[twice + k] = True
        lines = W.split(texts, b"\n")
        key = W.hashes(texts, lines) + W.mix(lines.text.astype(np.uint64))
        solid = np.concatenate([[0], np.cumsum(~texts.flags(W.WHITE))])
        worded = solid[lines.end] > solid[lines.start]
        first = np.zeros(len(key), bool)
        first[np.unique(key, return_index=True)[1]] = True
        code_point = (data & 0xC0) != 0x80
        in_words = ~texts.flags(W.WHITE)
        capital = (data >= 65) & (data <= 90)
        measured = (
            found.per_text(n),
            texts.per_text(code_point & in_words),
            texts.per_text(texts.flags(SYMBOLS)),
            np.bincount(lines.text[worded & ~first], minlength=n),
            np.bincount(found.text[covered[:-1]], minlength=n),
            np.bincount(lines.text[worded], minlength=n),
            texts.per_text(capital | ((data >= 97) & (data <= 122))),
            texts.per_text(capital),
            texts.per_text(data == 33),
        )
        column = pa.StructArray.from_arrays([pa.array(m, pa.int64()) for m in measured], list(MEASURES))
        yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "measured"])


def _measured(docs: DataFrame) -> DataFrame:
    schema = T.StructType([*docs.schema, T.StructField("measured", T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))])
    return docs.mapInArrow(_measure, schema)


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and `failed`, the bits of the rules that the text fails."""
    bits = " + ".join(f"CASE WHEN {condition} THEN {1 << bit}L ELSE 0L END" for bit, _, condition in RULES)
    found = _measured(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return found.select("doc_id", "measured.*").withColumn("failed", F.expr(bits))


def accepted(docs: DataFrame, version: int = CURRENT) -> DataFrame:
    """The rows, with all their columns, that a policy keeps. Names are set aside meanwhile, so none clash."""
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    text = f"c{docs.columns.index('text')}"
    found = _measured(plain.withColumnRenamed(text, "text"))
    rejected = " OR ".join(f"({condition})" for bit, _, condition in RULES if POLICIES[version] >> bit & 1)
    for m in MEASURES:
        rejected = re.sub(rf"\b{m}\b", f"measured.{m}", rejected)
    return found.where(f"NOT ({rejected})").drop("measured").toDF(*docs.columns)


def passes(version: int = CURRENT, failed: Column | str = "failed") -> Column:
    """Whether the stored bits satisfy the policy."""
    failed = F.col(failed) if isinstance(failed, str) else failed
    return failed.bitwiseAND(F.lit(POLICIES[version])) == 0


def ablation(stored: DataFrame, version: int = CURRENT) -> DataFrame:
    """Per rule of a policy: documents that fail it, and those that only it rejects.

    One aggregate over the bits; every task sends one row. Columns: rule, n_failed, n_alone.
    """
    relevant = F.col("failed").bitwiseAND(F.lit(POLICIES[version]))
    names = [name for _, name, _ in RULES if BIT[name] & POLICIES[version]]
    counts = stored.agg(
        *(F.count_if(relevant.bitwiseAND(F.lit(BIT[name])) != 0).alias(f"{name}_failed") for name in names),
        *(F.count_if(relevant == BIT[name]).alias(f"{name}_alone") for name in names),
    )
    rows = [F.struct(F.lit(m).alias("rule"), F.col(f"{m}_failed").alias("n_failed"), F.col(f"{m}_alone").alias("n_alone")) for m in names]
    return counts.select(F.inline(F.array(*rows)))
