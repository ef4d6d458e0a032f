"""Removal of repeated passages, found by difference-cover anchors.

A window is `span` consecutive words of a document. A word goes if a window over it has the same words as
one that starts earlier (smaller doc_id, or same document and earlier start). Windows are judged on the
input.

The positions {0, 1, 3, 9} modulo 13 are a difference cover: for any two positions some shift below 13 puts
both on cover positions. So two equal windows of 20 words share an anchor, the hash of 8 words that begin
at a cover position in both. Only anchors (4 of 13 positions) are shuffled to find those that occur again;
from each such anchor the match is extended to the windows that contain it, which are compared by a 96-bit
hash of all their words.

Skew: within a slice of texts (4 MB) equal anchors and equal windows are settled at once, and one row for
each goes on, so a passage in every document costs one row a slice. Nothing is dropped or capped.

Defined results: NULL and empty texts have no words. doc_id names a document; rows that repeat a doc_id
repeat its text, and each gets the document's result. A row with a NULL doc_id has no place in the order: it
is compared with nothing and keeps its words. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadpulse.llm import folders
from threadpulse.llm import words as W

SPAN = 20
#: Difference cover of every residue modulo 13.
PERIOD, COVER = 13, (0, 1, 3, 9)
#: Bytes of text that are settled together before the shuffle.
SLICE = 4 << 20
ANCHOR = SPAN - PERIOD + 1


def _words(batch: pa.RecordBatch) -> tuple[W.Spans, np.ndarray, np.ndarray]:
    """Words of the texts, their hashes, and where each text's words begin."""
    texts = W.Texts.of(batch.column("text"))
    found = W.split(texts, W.WHITE)
    first = np.concatenate([[0], np.cumsum(found.per_text(batch.num_rows))])
    return found, W.hashes(texts, found), first


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.slices(batches, "text", SLICE):
        found, values, first = _words(batch)
        hashed = W.windows(values, ANCHOR)
        place = np.arange(len(hashed)) - first[found.text[: len(hashed)]]
        at = np.flatnonzero(W.same_text(found, ANCHOR) & np.isin(place % PERIOD, COVER))
        hashed, place, doc = hashed[at], place[at], _ids(batch)[found.text[at]]
        _, index, inverse, count = np.unique(hashed, return_index=True, return_inverse=True, return_counts=True)
        # An anchor that occurs again in this slice is settled here. One row of it tells the others of it.
        again = count[inverse] > 1
        lead = np.zeros(len(at), bool)
        lead[index] = True
        spread = np.where(again & ~lead, W.mix(hashed + W.mix(at.astype(np.uint64) + np.uint64(1))), hashed)
        yield pa.RecordBatch.from_arrays(
            [W.signed(spread), pa.array(doc), pa.array(np.where(again, ~place, place), pa.int32())],
            ["anchor", "doc_id", "place"],
        )


def repeated_anchors(docs: DataFrame, parts: int) -> DataFrame:
    """doc_id and places (binary, u32) of the anchors of a document that occur more than once anywhere."""
    found = docs.mapInArrow(_anchors, "anchor long, doc_id long, place int")  # ~place if settled in its slice
    number = F.count(F.lit(1)).over(Window.partitionBy("anchor"))
    again = found.repartition(parts, "anchor").withColumn("n", number).where("n > 1 OR place < 0")
    return again.select("doc_id", F.greatest("place", F.bitwise_not("place")).alias("place"))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.slices(batches, "text", SLICE):
        found, values, first = _words(batch)
        one, two = W.windows(values, SPAN), W.windows(W.mix(values + np.uint64(1)), SPAN)
        n = len(one)
        places = batch.column("places")
        offsets = places.offsets.to_numpy()
        at = places.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].astype(np.int64)
        row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
        inside = at <= np.diff(first)[row] - ANCHOR
        at = (at + first[row])[inside]
        low = np.maximum(at - (SPAN - ANCHOR), first[row[inside]])
        change = np.zeros(len(values) + 2, np.int32)
        np.add.at(change, low, 1)
        np.add.at(change, at + 1, -1)
        candidate = np.flatnonzero((np.cumsum(change)[:n] > 0) & W.same_text(found, SPAN))
        doc = _ids(batch)[found.text[candidate]]
        start = candidate - first[found.text[candidate]]
        one, two = one[candidate], two[candidate]
        order = np.lexsort((start, doc, two, one))
        one, two, doc, start = one[order], two[order], doc[order], start[order]
        same = np.zeros(len(order), bool)
        same[1:] = (one[1:] == one[:-1]) & (two[1:] == two[:-1])
        # the same document twice is no earlier document
        lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
        later = same & ((doc != doc[lead]) | (start != start[lead]))
        yield _window_rows(one[~same], two[~same], doc[~same], start[~same], np.zeros(len(order) - same.sum(), np.int64))
        order = np.lexsort((start[later], doc[later]))
        doc, start = doc[later][order], start[later][order]
        begins = np.ones(len(doc), bool)
        begins[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1)
        lead = np.flatnonzero(begins)
        last = np.concatenate([lead[1:], [len(doc)]])[: len(lead)] - 1
        spread = W.mix(doc[lead].astype(np.uint64) ^ (start[lead].astype(np.uint64) << np.uint64(40)))
        yield _window_rows(spread, np.zeros(len(lead), np.uint64), doc[lead], start[lead], start[last] - start[lead] + 1)


def _window_rows(one, two, doc, start, run) -> pa.RecordBatch:
    """Rows for windows, with run 0, or for runs of windows that are known not to be the first of their kind."""
    return pa.RecordBatch.from_arrays(
        [W.signed(one), pa.array(two.astype(np.uint32).view(np.int32)), pa.array(doc), pa.array(start << 32 | run)],
        ["hash1", "hash2", "doc_id", "spot"],
    )


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.slices(batches, "text", SLICE):
        rows = zip(batch.column("text").to_pylist(), batch.column("windows").to_pylist(), strict=True)
        n_words, n_removed, kept = [], [], []
        for text, windows in rows:
            words = (text or "").encode().split()
            if windows:
                change = np.zeros(len(words) + 1, np.int32)
                np.add.at(change, [w["start"] for w in windows], 1)
                np.add.at(change, [min(w["last"] + SPAN, len(words)) for w in windows], -1)
                stays = np.cumsum(change)[:-1] == 0
                left = list(compress(words, stays.tolist()))
            else:
                left = words
            n_words.append(len(words))
            n_removed.append(len(words) - len(left))
            kept.append(b" ".join(left).decode())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(n_words, pa.int64()),
                pa.array(n_removed, pa.int64()),
                pa.array(kept, pa.string()),
            ],
            ["doc_id", "n_words", "n_removed", "kept"],
        )


def deduplicate(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept, the words left joined by one space, for every row."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    placed = wanted.where("doc_id IS NOT NULL")
    places = folders.written(repeated_anchors(placed, parts), "anchors")
    places = places.groupBy("doc_id").agg(F.collect_set("place").alias("places"))
    candidates = placed.join(places, "doc_id").select("doc_id", "text", "places")
    windows = candidates.mapInArrow(_windows, "hash1 long, hash2 int, doc_id long, spot long")
    place = F.struct("doc_id", "spot")
    earliest = F.min(place).over(Window.partitionBy("hash1", "hash2"))
    run = F.col("spot").bitwiseAND(F.lit(0xFFFFFFFF))
    start = F.shiftright("spot", 32)
    removed = (
        windows.repartition(parts, "hash1", "hash2")
        .withColumn("earliest", earliest)
        .where((run > 0) | (F.col("earliest") < place))
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct(start.alias("start"), (start + F.greatest(run, F.lit(1)) - 1).alias("last"))).alias("windows"))
    )
    removed = folders.written(removed, "passages")
    return wanted.join(removed, "doc_id", "left").select("doc_id", "text", "windows").mapInArrow(
        _kept, "doc_id long, n_words long, n_removed long, kept string"
    )
