"""Registered queries against their SQL, and the pipeline against its operators one by one."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import corpus_pipeline
from threadpulse.llm import oracle, queries, rule_ledger, secret_structure

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    got = queries.queries()[name](spark, SF_DIR)
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({oracle.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(want)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    step, before = docs, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, step = step, stage(spark, step, SF_DIR)
        assert step.columns == docs.columns, name
        left = {r["doc_id"]: r["text"] for r in step.collect()}
        if name == "quality rules":
            good = rule_ledger.ledger(docs).where(rule_ledger.passes())
            assert set(left) == {r["doc_id"] for r in good.collect()} and len(left) < len(texts)
        elif name == "secret scan":
            assert all(t == secret_structure.redacted(texts[i], secret_structure.find(texts[i])[1]) for i, t in left.items())
        else:
            assert set(left) < {r["doc_id"] for r in before.collect()}
            assert all(t == texts[i] for i, t in left.items())
    result = corpus_pipeline.run(spark, SF_DIR)
    assert {r["doc_id"] for r in result.collect()} == set(left)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0, name


def test_near_duplicates_stage_keeps_every_text(spark):
    """Of a doc_id with two texts both stay, of rows that repeat a text one."""
    words = " ".join(f"w{k}" for k in range(80))
    rows = [(1, words, "en"), (1, words, "en"), (1, "another text of the same id", "en"), (2, words + " more", "en"), (None, words, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    left = corpus_pipeline.near_dedup(spark, docs, SF_DIR)
    assert left.columns == docs.columns
    assert sorted(map(tuple, left.collect()), key=repr) == sorted([rows[0], rows[2], rows[4]], key=repr)
