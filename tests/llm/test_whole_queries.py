"""Registered queries without SQL, as tables over sf0.001, against plain versions that share no code with them."""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array

import pytest
import sentencepiece
import tokenizers

from threadpulse.llm import queries

SF_DIR = "/root/testdata/sf0.001"

# The patterns of the base spans, with the least length of each.
SECRETS = [
    ("assign", re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 20),
    ("hex", re.compile(r"[0-9a-f]+"), 24),
]


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] for r in rows}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_token_output(spark, texts):
    tokenizer = tokenizers.Tokenizer.from_file(queries.WORD_TOKENIZER)
    want, start = [], 0
    for i in sorted(texts):
        ids = [*tokenizer.encode(texts[i] or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(array("I", ids).tobytes())))
        start += len(ids)
    got = queries.queries()["op5_token_output"](spark, SF_DIR).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, got.collect())) == want


def test_sentencepiece(spark, texts):
    model = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    want = []
    for i in sorted(texts):
        ids = model.encode(texts[i] or "", add_eos=True)
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(model.decode(ids))))
    got = queries.queries()["op8_sentencepiece"](spark, SF_DIR).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(map(tuple, got.collect())) == want


def test_secret_scan(spark, texts):
    rows = {r["doc_id"]: r for r in queries.queries()["op10_secret_scan"](spark, SF_DIR).collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        spans = []
        for rank, (kind, pattern, least) in enumerate(SECRETS):
            for m in pattern.finditer(text or ""):
                if len(m[m.re.groups]) >= least:
                    spans.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
        written = [s for *_, s in sorted(spans)]
        counts = tuple(sum(s.startswith(kind) for s in written) for kind, *_ in SECRETS)
        assert (rows[i]["n_assign"], rows[i]["n_access"], rows[i]["n_hex"]) == counts
        assert rows[i]["base_sha256"] == sha(",".join(written))
        assert set(written) <= set(rows[i]["spans"].split(","))


def test_language_id(spark, texts):
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang").collect()}
    rows = {r["doc_id"]: r for r in queries.queries()["op7_language_id"](spark, SF_DIR).collect()}
    assert rows.keys() == texts.keys()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for i, r in rows.items())
    judged = [rows[i]["lang_pred"] == lang for i, lang in langs.items() if lang and rows[i]["held_out"]]
    assert sum(judged) >= 0.8 * len(judged)


def test_toxicity(spark, texts):
    rows = {r["doc_id"]: r for r in queries.queries()["op9_toxicity"](spark, SF_DIR).collect()}
    assert rows.keys() == texts.keys()
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in rows.values())


def test_html_extraction(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    rows = {r["page_id"]: r for r in queries.queries()["op1_html_extraction"](spark, SF_DIR).collect()}
    assert rows.keys() == pages.keys()
    for i, r in rows.items():
        assert r["url"] == pages[i]["url"] and r["n_chars"] == len(r["text"])
        blocks = r["text"].split("\n\n") if r["text"] else []
        assert all(b and b == " ".join(b.split()) for b in blocks)
