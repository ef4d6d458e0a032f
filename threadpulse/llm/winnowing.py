"""Benchmark decontamination by winnowed fingerprints.

Words are lower-cased ASCII letters, digits and letters beyond ASCII. A window is `span` consecutive words
of a benchmark item; an item with fewer words is one window of its own width.

Winnowing: of the k-grams of each window the one with the smallest hash is selected, the rightmost of equal
ones. Neighbouring windows mostly select the same one, so only a part of all places is selected; these are
the fingerprints, kept as a table for the items. Two equal windows select the same k-gram at the same place
in them, so every shared span of that length meets in a fingerprint. A meeting extends to a window if the
words left and right of the k-gram agree as well: the fingerprint has, for each window that selected it, a
hash of these flanks. Fingerprint and flank together are 128 bits. A window no wider than a k-gram has no
flanks; a second hash of its words stands for them. As flanks are part of the join's key, a k-gram that is
common among items and documents makes no pairs of them.

Before the join, a document drops fingerprints that no item has, then flanks that none has. It asks two
bitmaps of a fixed 2**23 bits (1 MB each), built from the items by Spark; more items fill them, which costs
time and no hit.

Item windows are reduced to distinct ones before the join. Items are looked up once for each distinct set of
windows that a document has, so repeated items and passages that many documents share multiply no rows.
Both lookups read written tables, so that adaptive execution can part a hot window or set.

Defined results: NULL and empty texts have no words and no hits. Every row has a result row, a NULL doc_id
and rows that repeat a doc_id and its text too; texts of one doc_id are judged apart. Items with the same
item_id are one item; a NULL item_id is left out of the list of items but its windows hit. Without items
nothing is hit. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadpulse.llm import folders
from threadpulse.llm import words as W

#: ASCII that is no letter of a word, after lower-casing.
NOT_WORD = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
SPAN, GRAM = 10, 5
BITMAP_BITS = 1 << 23
_BUCKET = 1 << 15  # bits in a part of the bitmap


def select(values: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of width words: the hash of the k-gram that it selects, and the k-gram's place in it."""
    gram = min(gram, width)
    grams = W.windows(values, gram)
    n = max(0, len(values) - width + 1)
    smallest = grams[:n].copy()
    place = np.zeros(n, np.int64)
    for k in range(1, width - gram + 1):
        place[grams[k : k + n] <= smallest] = k
        np.minimum(smallest, grams[k : k + n], out=smallest)
    return smallest ^ W.mix(np.uint64([width]))[0], place


def flanks(values: np.ndarray, start: np.ndarray, place: np.ndarray, width: int, gram: int) -> np.ndarray:
    """A hash of the words of windows that are not in their selected k-gram, and of where it stands."""
    out = place.astype(np.uint64)
    for k in range(width):
        word = W.mix(values[start + k] + np.uint64(1))
        if gram < width:
            word[(place <= k) & (k < place + gram)] = 0
        out = W.mix(out + word)
    return out


def item_fingerprints(items: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """The selected places of every item: item_id, width, place, fingerprint, and flanks, one for each window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text"):
            texts = W.Texts.of(batch.column("text")).lowered()
            found = W.split(texts, NOT_WORD)
            values = W.hashes(texts, found)
            counts = found.per_text(batch.num_rows)
            first = np.concatenate([[0], np.cumsum(counts)])
            for width in np.unique(np.minimum(counts[counts > 0], span)).tolist():
                ok = W.same_text(found, width)
                if width < span:
                    ok &= counts[found.text[: len(ok)]] == width
                start = np.flatnonzero(ok)
                selected, place = (part[start] for part in select(values, width, gram))
                at = start + place  # never falls: the windows of one place stand together
                lead = np.flatnonzero(np.diff(at, prepend=-1))
                own = W.signed(flanks(values, start, place, width, min(gram, width)))
                text = found.text[at[lead]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("item_id").cast(pa.int64()).take(pa.array(text)),
                        pa.array(np.full(len(lead), width, np.int32)),
                        pa.array(at[lead] - first[text]),
                        W.signed(selected[lead]),
                        pa.ListArray.from_arrays(pa.array(np.append(lead, len(at)).astype(np.int32)), own),
                    ],
                    ["item_id", "width", "place", "fingerprint", "flanks"],
                )

    schema = "item_id long, width int, place long, fingerprint long, flanks array<long>"
    return items.select("item_id", "text").mapInArrow(run, schema)


def bitmap(values: DataFrame, column: str) -> np.ndarray:
    """The lowest bits of a column of hashes as a bitmap of BITMAP_BITS bits: at most 256 rows of 4 KB."""
    bit = F.col(column).bitwiseAND(F.lit(BITMAP_BITS - 1))
    parts = (
        values.select(F.floor(bit / _BUCKET).cast("int").alias("bucket"), (bit % _BUCKET).alias("position"))
        .groupBy("bucket")
        .agg(F.bitmap_construct_agg("position").alias("bits"))
        .collect()
    )
    out = np.zeros((BITMAP_BITS // _BUCKET, _BUCKET // 8), np.uint8)
    for row in parts:
        out[row["bucket"]] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def _set(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = (values & np.uint64(BITMAP_BITS - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def document_fingerprints(docs: DataFrame, widths: list[int], selected, around, gram: int = GRAM) -> DataFrame:
    """A row for each text, without width, and one for each window that may be one of an item.

    selected and around are broadcast bitmaps of fingerprints and flanks. text_hash tells apart texts of one doc_id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, flanked = selected.value, around.value
        for batch in W.slices(batches, "text"):
            n = batch.num_rows
            texts = W.Texts.of(batch.column("text")).lowered()
            found = W.split(texts, NOT_WORD)
            values = W.hashes(texts, found)
            counts = found.per_text(n)
            first = np.concatenate([[0], np.cumsum(counts)])
            # the rows of texts themselves; their fingerprint only spreads them over tasks
            rows, starts, kinds = [np.arange(n)], [np.zeros(n, np.int64)], [np.zeros(n, np.int32)]
            prints = [W.mix(np.arange(n, dtype=np.uint64) + np.uint64(len(values)))]
            hits = [np.zeros(n, np.uint64)]
            for width in widths:
                smallest, place = select(values, width, gram)
                at = np.flatnonzero(W.same_text(found, width) & _set(known, smallest))
                own = flanks(values, at, place[at], width, min(gram, width))
                there = _set(flanked, own)
                at, own = at[there], own[there]
                rows.append(found.text[at])
                starts.append(at - first[found.text[at]])
                kinds.append(np.full(len(at), width, np.int32))
                prints.append(smallest[at])
                hits.append(own)
            text, kind = np.concatenate(rows), np.concatenate(kinds)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()).take(pa.array(text)),
                    batch.column("text_hash").take(pa.array(text)),
                    pa.array(counts[text], pa.int64()),
                    pa.array(np.concatenate(starts)),
                    pa.array(kind, mask=kind == 0),
                    W.signed(np.concatenate(prints)),
                    W.signed(np.concatenate(hits)),
                ],
                ["doc_id", "text_hash", "n_words", "start", "width", "fingerprint", "flank"],
            )

    schema = "doc_id long, text_hash long, n_words long, start long, width int, fingerprint long, flank long"
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return hashed.mapInArrow(run, schema)


_KEY = ["width", "fingerprint", "flank"]


def _covered(hits: DataFrame) -> DataFrame:
    """Per text: n_words, n_hit (words in a hit window), the distinct windows, and how many rows have the text."""
    key = ["doc_id", "text_hash"]
    # rows that repeat a text are counted before they meet in one task
    once = hits.groupBy(*key, "n_words", "start", "width", "window").agg(F.count(F.lit(1)).alias("n"))
    end = F.col("start") + F.col("width")
    # each window adds what lies beyond all windows that start before it
    before = Window.partitionBy(*key).orderBy("start", "width").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max(end).over(before), F.lit(0))
    new = F.when(F.col("width").isNotNull(), F.greatest(F.lit(0), end - F.greatest(F.col("start"), reach))).otherwise(0)
    # a name for the set of windows; texts without one get names of their own, which spreads them over tasks
    own = F.when(F.size("windows") == 0, F.xxhash64(*key)).cast("string")
    return (
        once.withColumn("new", new)
        .groupBy(*key)
        .agg(
            F.max("n_words").alias("n_words"),
            F.sum("new").alias("n_hit"),
            F.array_sort(F.collect_set("window")).alias("windows"),
            F.sum(F.when(F.col("width").isNull(), F.col("n"))).alias("copies"),
        )
        .withColumn("found", F.md5(F.concat_ws(",", own, F.col("windows").cast("array<string>"))))
    )


def overlaps(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and items (their ids, as text)."""
    context = docs.sparkSession.sparkContext
    stored = folders.written(item_fingerprints(items, span, gram), "item-fingerprints")
    widths = sorted(r["width"] for r in stored.select("width").distinct().collect())  # at most span values
    owned = stored.select("item_id", "width", "fingerprint", F.explode("flanks").alias("flank"))
    prints = document_fingerprints(
        docs, widths, context.broadcast(bitmap(stored, "fingerprint")), context.broadcast(bitmap(owned, "flank")), gram
    )
    known = folders.written(owned.select(*_KEY).distinct().withColumn("window", F.xxhash64(*_KEY)), "item-windows")
    hits = prints.join(known, _KEY, "left").where("window IS NOT NULL OR width IS NULL")
    covered = folders.written(_covered(hits), "benchmark-hits")
    owners = owned.where("item_id IS NOT NULL").select(F.xxhash64(*_KEY).alias("window"), F.col("item_id").cast("string").alias("item_id"))
    sets = covered.select("found", F.explode("windows").alias("window")).distinct()
    ids = sets.join(owners, "window").groupBy("found").agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    named = covered.join(folders.written(ids, "benchmark-items"), "found", "left").withColumn("ids", F.coalesce("ids", F.array()))
    listed = F.array_join("ids", ",")
    return named.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("ids").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        listed.alias("items"),
        "text_hash",
    )
