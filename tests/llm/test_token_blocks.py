"""The Java half of op5_token_output against the tokenizers library and a decoder in plain Python."""

from __future__ import annotations

import json
import random
import zlib

import numpy as np
import pytest
import tokenizers
from pyspark.sql import functions as F

from threadpulse.llm import jvm, queries, range_coder

MASK, ONE = (1 << 64) - 1, 1 << 16


def decoded(words: list[int], n: int, vocabulary: int) -> list[int]:
    """Ids of a block, straight from the description of range_coder, with plain lists and sums."""
    words, low, width, code = iter(words), 0, MASK, 0
    for _ in range(4):
        code = code << 16 | next(words)

    def take(start, size, unit):
        nonlocal low, width, code
        low, width = (low + start * unit) & MASK, size * unit
        while (fixed := (low ^ (low + width) & MASK) < 1 << 48) or width < 1 << 32:
            if not fixed:
                width = -low & 0xFFFFFFFF
            code, low, width = (code << 16 | next(words, 0)) & MASK, low << 16 & MASK, width << 16 & MASK

    counts, spelled, ids, last, before = [1] * vocabulary, [], [], 0, 0
    slots = {}
    chances, trust = {}, {}
    for step in range(1, n + 1):
        contexts = (
            (2, ((last * 0x9E3779B1 ^ before * 0x85EBCA77) & 0xFFFFFFFF) >> 18),
            (1, (last * 0x9E3779B1 & 0xFFFFFFFF) >> 20),
        )
        guesses = [slots.get(c, (0, 0)) for c in contexts]
        found = None
        for k, (guess, sure) in enumerate(guesses):
            if found is not None or not sure or k and guesses[0][1] and guess == guesses[0][0]:
                continue
            keys = (k, "own", sure), (k, "both", guesses[0][1], guesses[1][1])
            parts, weights = [chances.get(x, ONE // 2) for x in keys], [trust.get((k, i), ONE // 2) for i in (0, 1)]
            p = min(max(sum(a * b for a, b in zip(parts, weights, strict=True)) // sum(weights), 64), ONE - 64)
            unit = width // ONE
            hit = ((code - low) & MASK) // unit < p
            take(*((0, p) if hit else (p, ONE - p)), unit)
            for i, key in enumerate(keys):
                chances[key] = parts[i] + (((ONE if hit else 0) - parts[i]) >> 4)
                given = parts[i] if hit else ONE - parts[i]
                trust[k, i] = max(256, weights[i] + ((given - weights[i]) >> 4))
            if hit:
                found = guess
        if found is None:
            unit = width // sum(counts)
            value, start, found = ((code - low) & MASK) // unit, 0, 0
            while start + counts[found] <= value:
                start, found = start + counts[found], found + 1
            take(start, counts[found], unit)
            spelled.append(found)
        for context, (guess, sure) in zip(contexts, guesses, strict=True):
            if sure and guess == found:
                slots[context] = guess, min(sure + 1, 15)
            else:
                slots[context] = (guess, sure >> 1) if sure > 1 else (found, 1)
        if step % 1024 == 0 or step in (32, 128, 512):
            for i in spelled:
                counts[i] += 24
            spelled = []
        ids.append(found)
        last, before = found, last
    return ids


def odd_texts() -> list[str | None]:
    """Every letter up to kana beside letters, digits and signs, and strings of letters that have rules of their own."""
    pick = random.Random(7)
    own = list("abcdeStTRelLmMvVdD''''.,-!\"<||>12  \n\t\r\v\f\x1c\0\x7féÈßÿŸñ×÷ŽžİıſŉΣσςάЀяЖ—–“”’…‰\x85\xa0́ª²中😀Å")
    texts = [f"x{c}y A{c}B {c} {c}{c}' 1{c}2 .{c}s it'{c}s I'{c}LL {c}'re" for c in map(chr, range(0x3100))]
    texts += ["".join(pick.choice(own) for _ in range(pick.randrange(24))) for _ in range(5_000)]
    texts += [c * n for c in ("a", "é", "-", "—") for n in (84, 86, 87, 127, 128, 129, 255, 256, 257, 300, 3_000)]
    return [*texts, "word " * 5_000, "<|startoftext|>", "a<|endoftext|>b <|x", "<|ENDOFTEXT|>", "I'LL it's 'twas x'", None, "", " \n "]


def test_ids_of_java_are_those_of_the_library(spark):
    texts = odd_texts()
    model = range_coder._model(queries.WORD_TOKENIZER, 2)
    encode = "threadpulse.llm.TokenBlocks$Encode", "ids binary, words binary", "test", model
    jvm.register(spark, "TokenBlocks.java", {"token_ids": encode})
    table = spark.createDataFrame(list(enumerate(texts)), "i long, text string").repartition(4)
    rows = sorted(table.select("i", F.call_function("token_ids", F.col("text").cast("binary")).alias("t")).select("i", "t.*").collect())
    coder = range_coder.Ids(queries.WORD_TOKENIZER, 2, whole_words=False)
    got = coder.filled([bytes(r["ids"]) for r in rows], [r["words"] and bytes(r["words"]) for r in rows])
    assert got == coder.of(texts)
    known = [chr(i) for i in range(0x3100) if rows[i]["words"] is None]
    assert {*"azAZ09.'|-", *"éÈßÿ", *"Žž", *"Σσς", *"Яя", *"—“”’…"} <= {*known} and len(known) > 500


def test_blocks_hold_what_a_plain_decoder_reads(spark, tmp_path):
    path = str(tmp_path / "blocks")
    pick = random.Random(3)
    varied = " ".join(pick.choice(["the", "cat", "and", "dog"]) if i % 3 else f"x{pick.randrange(99)}" for i in range(1_500))
    texts = [t for t in odd_texts()[::97] if t] + ["the cat sat on the mat, the cat ran. " * 60, varied]
    docs = spark.createDataFrame([(None, "no id at all"), *((i, t) for i, t in enumerate(texts))], "doc_id long, text string")
    range_coder.write(docs, path, queries.WORD_TOKENIZER, 2, block_ids=1_500)
    coder, want = range_coder.Ids(queries.WORD_TOKENIZER, 2, whole_words=False), {}
    for i, text in [(None, "no id at all"), *enumerate(texts)]:
        want[i] = np.frombuffer(coder.of([text])[0], "<u4").tolist()
    blocks = spark.read.parquet(path).orderBy("part", "block").collect()
    assert any(b["block"] for b in blocks)
    got = {}
    for block in blocks:
        vocabulary, table, words = range_coder.unpack(bytes(block["payload"]))
        ids = decoded(words.tolist(), int(table["n"].sum()), vocabulary)
        for doc_id, n, flags in table.tolist():
            own = got.setdefault(None if flags & range_coder.NULL_ID else doc_id, [])
            assert bool(own) == bool(flags & range_coder.CONTINUED)
            own += ids[:n]
            ids = ids[n:]
    assert got == want
    pieces = range_coder.read(spark, path).orderBy("part", "block", "place").collect()
    read = {}
    for piece in pieces:
        read.setdefault(piece["doc_id"], []).extend(np.frombuffer(piece["ids"], "<u4").tolist())
    assert read == want


def test_blocks_are_read_without_python(spark, tmp_path):
    """Decoding id by id in Python took most of the time of the query."""
    path = str(tmp_path / "blocks")
    docs = spark.createDataFrame([(1, "a few words"), (2, "and some more " * 99)], "doc_id long, text string")
    range_coder.write(docs, path, queries.WORD_TOKENIZER, 2, block_ids=50)
    pieces = range_coder.read(spark, path)
    for table in (pieces, range_coder.positions(pieces)):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "Arrow" not in plan and "Python" not in plan


def test_damaged_block_is_an_error(spark, tmp_path):
    path, other = str(tmp_path / "blocks"), str(tmp_path / "damaged")
    docs = spark.createDataFrame([(1, "a few words")], "doc_id long, text string")
    range_coder.write(docs, path, queries.WORD_TOKENIZER, 2)
    payload = bytearray(spark.read.parquet(path).first()["payload"])
    payload[-1] ^= 1
    spark.createDataFrame([(0, 0, payload)], "part int, block int, payload binary").write.parquet(other)
    with pytest.raises(Exception, match="checksum"):
        range_coder.read(spark, other).collect()


def test_other_tokenizers_are_left_to_the_library(spark, tmp_path):
    model = json.loads(tokenizers.Tokenizer.from_file(queries.WORD_TOKENIZER).to_str())
    model["normalizer"]["normalizers"].pop()  # case stays
    (tmp_path / "cased.json").write_text(json.dumps(model))
    own, path = str(tmp_path / "cased.json"), str(tmp_path / "blocks")
    assert range_coder._model(own, 2) is None
    texts = ["Some Words and MORE", "é È 中", None, "lower 12 words " * 400]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    range_coder.write(docs, path, own, 2, block_ids=500)
    rows = sorted(range_coder.positions(range_coder.read(spark, path)).collect(), key=lambda r: r["start"])
    start = 0
    for i, ids in enumerate(range_coder.Ids(own, 2, whole_words=False).of(texts)):
        assert tuple(rows[i]) == (i, start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4
    assert len(rows) == len(texts)
