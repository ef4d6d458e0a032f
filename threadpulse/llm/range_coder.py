"""Token ids in compressed binary blocks: an adaptive context-mixing range coder.

An id is predicted from the ids before it: by what last followed the same two ids (order 2), by what last
followed the same id (order 1), and by how often each id had to be spelled out (order 0). Two yes/no
decisions ask whether a prediction holds; each is coded with the mean of two adaptive probabilities,
weighted by how well each has done of late. If neither prediction holds, the order-0 counts code the id.
All of it is integer arithmetic, so a decoder on any machine goes through the same states.

Blocks are independent: each starts with an empty model and carries a header, a table of its documents,
the code words and a checksum over all of it, so a damaged block is detected and costs no other.

What goes letter by letter or id by id is Java (TokenBlocks.java), which runs inside Spark: the coder, and
for tokenizers of the kind of _PARTED the encoding of all words but those with letters outside a few common
alphabets. These words, and all texts for other tokenizers, go to the tokenizers library in Python.

Layout of a block (little-endian): magic "TPR1", u32 vocabulary size, u32 documents, u32 ids, u32 code
words, u32 crc32 of everything after this field; then per document i64 doc_id, u32 ids, u8 flags (1: its
ids began in the block before, 2: doc_id is NULL); then u16 code words.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from threadpulse.llm import folders, jvm
from threadpulse.llm import words as W

MAGIC = b"TPR1"
BLOCK_IDS = 8_192
CACHED_WORDS, CACHED_LETTERS = 500_000, 64
SENT_ROWS, SENT_BLOCKS = 256, 64
HOLE = 0xFFFFFFFF  # where Java left a word to the library

_HEAD = struct.Struct("<4sIIIII")
_DOCUMENT = np.dtype([("doc_id", "<i8"), ("n", "<u4"), ("flags", "u1")])
CONTINUED, NULL_ID = 1, 2


def unpack(block: bytes) -> tuple[int, np.ndarray, np.ndarray]:
    """Vocabulary size, table of documents and code words; ValueError if the block is damaged."""
    if len(block) < _HEAD.size or block[:4] != MAGIC:
        raise ValueError("not a block of token ids")
    _, vocabulary, n, ids, words, checksum = _HEAD.unpack_from(block)
    rest = block[_HEAD.size :]
    if zlib.crc32(struct.pack("<4I", vocabulary, n, ids, words) + rest) != checksum:
        raise ValueError("checksum of a block of token ids does not match")
    split = n * _DOCUMENT.itemsize
    return vocabulary, np.frombuffer(rest[:split], _DOCUMENT), np.frombuffer(rest[split:], "<u2")


class Ids:
    """Ids of whole texts by a tokenizer of the tokenizers library, as little-endian 32-bit bytes.

    ASCII white space always separates words of these tokenizers, so words are encoded one by one and kept
    in a bounded table. With whole_words false the library gets the whole text each time.
    """

    def __init__(self, path: str, end_id: int, whole_words: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.end = np.array([end_id], "<u4").tobytes()
        self.whole_words = whole_words
        self.cache: dict[str, bytes] = {}

    def _encoded(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def of(self, texts: list[str | None]) -> list[bytes]:
        if not self.whole_words:
            return [b + self.end for b in self._encoded([t or "" for t in texts])]
        return [b"".join(ids) + self.end for ids in self._of_words([(t or "").translate(_SPACES).split(" ") for t in texts])]

    def filled(self, ids: list[bytes], words: list[bytes | None]) -> list[bytes]:
        """Ids of texts from ids with holes and the words that belong there."""
        found = iter(self._of_words([w.decode().split(" ") for w in words if w is not None]))
        return [own if w is None else _with_words(own, next(found)) for own, w in zip(ids, words, strict=True)]

    def _of_words(self, words: list[list[str]]) -> list[list[bytes]]:
        if len(self.cache) > CACHED_WORDS:
            self.cache.clear()
        known, rare = self.cache, {}
        for own in words:
            for w in own:
                if w not in known:
                    rare[w] = b""
        if rare:
            missing = list(rare)
            for w, b in zip(missing, self._encoded(missing), strict=True):
                if len(w) <= CACHED_LETTERS:
                    known[w] = b
                rare[w] = b
        out = []
        for own in words:
            try:
                out.append([known[w] for w in own])
            except KeyError:  # words too long to keep
                out.append([known[w] if w in known else rare[w] for w in own])
        return out


def _with_words(ids: bytes, words: list[bytes]) -> bytes:
    holes = (4 * np.flatnonzero(np.frombuffer(ids, "<u4") == HOLE)).tolist()
    pieces, start = [], 0
    for hole, own in zip(holes, words, strict=True):
        pieces += [ids[start:hole], own]
        start = hole + 4
    return b"".join([*pieces, ids[start:]])


_SPACES = {c: " " for c in W.WHITE}
_tokenizers: dict[tuple, Ids] = {}

#: The tokenizers that Java knows: bytes of words in lower case, parted so, with a mark at their end.
_PARTED = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
_MERGED = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "byte_fallback": False, "ignore_merges": False}


def _model(path: str, end_id: int) -> bytes | None:
    """Number of merges, end id, ids of bytes and merges of a tokenizer for Java, deflated; None if it is of another kind."""
    made = json.loads(Tokenizer.from_file(path).to_str())
    merged, parted = made["model"], all(made[k] == v for k, v in _PARTED.items())
    special = all(t["content"].startswith("<|") and not t["lstrip"] and not t["rstrip"] for t in made["added_tokens"])
    if not parted or not special or not _MERGED.items() <= merged.items() or merged["end_of_word_suffix"] != "</w>":
        return None
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printed]
    letters = dict(zip(printed, map(chr, printed), strict=True)) | {b: chr(256 + i) for i, b in enumerate(others)}
    ids, pairs = merged["vocab"], [m.split(" ") if isinstance(m, str) else m for m in merged["merges"]]
    try:
        found = [len(pairs), end_id, *(ids[letters[b]] for b in range(256)), *(ids[letters[b] + "</w>"] for b in range(256))]
        found += [i for a, b in pairs for i in (ids[a], ids[b], ids[a + b])]
    except KeyError:
        return None
    return zlib.compress(np.array(found, "<i4").tobytes())


def _blocks(rows: Iterator[tuple[int | None, bytes]], block_ids: int) -> Iterator[tuple[bytes, bytes]]:
    """Tables and ids of blocks of up to block_ids ids from documents in order; a longer document goes on in the next."""
    documents: list[tuple[int, int, int]] = []
    pieces: list[bytes] = []
    held = 0
    for doc_id, ids in rows:
        flags = NULL_ID if doc_id is None else 0
        at = 0
        while at < len(ids):
            part = ids[at : at + 4 * (block_ids - held)]
            documents.append((doc_id or 0, len(part) // 4, flags | (CONTINUED if at else 0)))
            pieces.append(part)
            held, at = held + len(part) // 4, at + len(part)
            if held == block_ids:
                yield np.array(documents, _DOCUMENT).tobytes(), b"".join(pieces)
                documents, pieces, held = [], [], 0
    if documents:
        yield np.array(documents, _DOCUMENT).tobytes(), b"".join(pieces)


_PIECES = "array<struct<place int, doc_id long, continued boolean, ids binary>>"
_FUNCTIONS = {
    "token_block": ("threadpulse.llm.TokenBlocks$Pack", "binary"),
    "token_pieces": ("threadpulse.llm.TokenBlocks$Unpack", _PIECES),
    "joined_crc32": ("threadpulse.llm.TokenBlocks$JoinedCrc", "long"),
}


def _register(spark: SparkSession) -> None:
    jvm.register(spark, "TokenBlocks.java", _FUNCTIONS)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, block_ids: int = BLOCK_IDS) -> None:
    """Encodes every whole text and writes the blocks in ascending doc_id order (NULL first).

    The path becomes a Parquet table (part, block, payload): parts ascend with doc_id, blocks within a part.
    The documents are dealt by ranges of doc_id, so no task depends on another one's rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (tokenizer, end_id)
        coder = _tokenizers.get(key) or _tokenizers.setdefault(key, Ids(tokenizer, end_id))
        part = TaskContext.get().partitionId()

        def rows() -> Iterator[tuple[int | None, bytes]]:
            for batch in batches if model else W.slices(batches, "text"):
                for i in range(0, batch.num_rows, SENT_ROWS):
                    doc_id, given = batch.slice(i, SENT_ROWS).columns
                    ids = coder.filled(*(x.to_pylist() for x in given.flatten())) if model else coder.of(given.to_pylist())
                    yield from zip(doc_id.to_pylist(), ids, strict=True)

        blocks = enumerate(_blocks(rows(), block_ids))
        while found := [(part, n, coder.vocabulary, *block) for n, block in itertools.islice(blocks, SENT_BLOCKS)]:
            columns = zip(zip(*found, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)
            names = ["part", "block", "vocabulary", "documents", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names)

    spark, model = docs.sparkSession, _model(tokenizer, end_id)
    _register(spark)
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = wanted.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    if model:
        encode = "threadpulse.llm.TokenBlocks$Encode", "ids binary, words binary", hashlib.sha256(model).hexdigest(), model
        jvm.register(spark, "TokenBlocks.java", {"token_ids": encode})
        dealt = dealt.select("doc_id", F.call_function("token_ids", F.col("text").cast("binary")).alias("text"))
    open_ = dealt.mapInArrow(run, "part int, block int, vocabulary int, documents binary, ids binary")
    payload = F.call_function("token_block", "documents", "ids", "vocabulary")
    open_.select("part", "block", payload.alias("payload")).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Pieces of documents in the blocks of a path: part, block, place, doc_id, continued, ids (binary, u32)."""
    _register(spark)
    blocks = spark.read.schema("part int, block int, payload binary").parquet(path)
    return blocks.select("part", "block", F.inline(F.call_function("token_pieces", "payload")))


def positions(pieces: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the pieces that read() gives.

    Start sums the ids before a document: within its part by a window, before the part by one number per
    part. Only documents longer than a block have more than one piece.
    """
    _register(pieces.sparkSession)
    measured = pieces.select(
        *("part", "block", "place", "doc_id", "continued"),
        (F.length("ids") / 4).cast("long").alias("n"),
        F.crc32("ids").alias("crc"),
    )
    measured = folders.written(measured, "token-pieces")
    in_part = Window.partitionBy("part").orderBy("block", "place")
    numbered = measured.withColumn("row", F.sum((~F.col("continued")).cast("long")).over(in_part))
    documents = numbered.groupBy("part", "row").agg(
        F.first("doc_id").alias("doc_id"),
        F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("block", "place", "n", "crc"))).alias("found"),
    )
    earlier = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    parts = measured.groupBy("part").agg(F.sum("n").alias("n"))
    before = parts.select(
        F.col("part").alias("p"),
        F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
    )
    return documents.join(F.broadcast(before), F.col("part") == F.col("p")).select(
        "doc_id",
        (F.col("offset") + F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0))).alias("start"),
        "n_tokens",
        F.when(F.size("found") == 1, F.col("found")[0]["crc"])
        .otherwise(F.call_function("joined_crc32", F.col("found")["crc"], F.col("found")["n"]))
        .alias("ids_crc32"),
    )
