"""Exact duplicates through counting quotient filters.

Two texts are equal when they are identical after every run of white space became one space. Each text has
a 64-bit fingerprint. Every task enters the fingerprints of its rows into counting quotient filters, one for
each range of leading bits (shard). A filter is a sorted sequence: the next bits of a fingerprint (the
quotient) are its place, kept as one bit, and only the rest (the remainder) is stored, followed by its count
if that is above one. As nothing is lost, filters of a shard merge by merging their sorted remainders and
adding counts. So a fingerprint costs a task one entry however often it occurs, and a group of copies never
meets in one task.

Fingerprints with a count above one go on to byte verification: their texts are grouped by the bytes, with
sums per task before the shuffle. Equal fingerprints of different texts part there. Where there are more
repeated fingerprints than `BROADCAST_ROWS`, all texts are grouped, one copy per task and text; the result is
the same. Rows get their group by fingerprint and SHA-256; the groups that hold more rows than one task should
take are known by their counts, there are few of them, and they are broadcast while their rows are dealt out.

Defined results: NULL counts as the empty text, and empty texts are equal to each other; a text of white space
alone is one space and differs from the empty one. Of equal texts the smallest doc_id stays; rows that repeat
that doc_id and text are marked alike, each counts in group_size, and `deduplicated` keeps one of them. A NULL
doc_id never stays beside another one; a group without any doc_id has keep_id NULL, and its rows stay. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadpulse.llm import folders

BITS = 64
#: Fingerprints that a task enters before it hands out its filters, and those that a shard should hold.
FILL, SHARD_ROWS = 1 << 20, 1 << 20
#: Repeated fingerprints that may be broadcast (8 bytes each).
BROADCAST_ROWS = 1 << 20
#: Rows of a group that one task should take, and the share of all rows above which a group always is hot.
ROWS_PER_TASK, MIN_SHARE = 2_000_000, 1 / 100_000

_HEADER = 4  # numbers before a filter's arrays: bits of a value, bits of the quotient, slots, bytes of a slot


def encode(values: np.ndarray, counts: np.ndarray, width: int) -> bytes:
    """A counting quotient filter of ascending distinct values below 2**width.

    Runs of equal quotients lie side by side in slots. Three bit vectors tell which quotients occur, which
    slot ends a run, and which slots hold a digit of the count of the remainder before them.
    """
    quotient_bits = min(width, max(0, int(len(values) - 1).bit_length())) if len(values) else 0
    rest = width - quotient_bits
    size = max(1, -(-rest // 8))
    quotient = (values >> np.uint64(rest)) if rest < 64 else np.zeros(len(values), np.uint64)
    remainder = values & np.uint64((1 << rest) - 1)
    occupied = np.zeros(1 << quotient_bits, bool)
    occupied[quotient.astype(np.int64)] = True
    left, digits = counts.astype(np.uint64) - np.uint64(1), np.zeros(len(values), np.int64)
    while left.any():
        digits += left > 0
        left = left >> np.uint64(8 * size) if size < 8 else np.zeros_like(left)
    place = np.cumsum(digits + 1) - digits - 1
    n = int((digits + 1).sum())
    slots, counter, ends = np.zeros(n, np.uint64), np.ones(n, bool), np.zeros(n, bool)
    slots[place] = remainder
    counter[place] = False
    left, step = counts.astype(np.uint64) - np.uint64(1), 0
    while (more := digits > step).any():
        step += 1
        slots[place[more] + step] = left[more] & np.uint64((1 << 8 * size) - 1)
        left = left >> np.uint64(8 * size) if size < 8 else left
    last = np.ones(len(values), bool)
    last[:-1] = quotient[1:] != quotient[:-1]
    ends[(place + digits)[last]] = True
    header = np.array([width, quotient_bits, n, size], np.int64)
    packed = slots.view(np.uint8).reshape(-1, 8)[:, :size]
    return b"".join([header.tobytes(), *(np.packbits(x).tobytes() for x in (occupied, ends, counter)), packed.tobytes()])


def decode(data: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """The ascending values of a filter, their counts and the bits of a value."""
    width, quotient_bits, n, size = np.frombuffer(data, np.int64, _HEADER).tolist()
    at, bits = 8 * _HEADER, []
    for length in (1 << quotient_bits, n, n):
        taken = (length + 7) // 8
        bits.append(np.unpackbits(np.frombuffer(data, np.uint8, taken, at), count=length).astype(bool))
        at += taken
    occupied, ends, counter = bits
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :size] = np.frombuffer(data, np.uint8, n * size, at).reshape(n, size)
    slots = wide.reshape(-1).view(np.uint64)
    place = np.flatnonzero(~counter)
    run = (np.cumsum(ends) - ends)[place]
    quotient = np.flatnonzero(occupied)[run].astype(np.uint64)
    rest = width - quotient_bits
    values = ((quotient << np.uint64(rest)) if rest < 64 else np.uint64(0)) | slots[place]
    counts = np.ones(len(place), np.uint64)
    owner = np.cumsum(~counter) - 1
    digit = np.flatnonzero(counter)
    step = digit - place[owner[digit]] - 1
    np.add.at(counts, owner[digit], slots[digit] << (step * 8 * size).astype(np.uint64))
    return values, counts, width


def merge(one: bytes, two: bytes) -> bytes:
    """The filter of both filters' values: their sorted remainders merged, counts of equal ones added."""
    a, a_counts, width = decode(one)
    b, b_counts, _ = decode(two)
    at = np.searchsorted(a, b)
    known = at < len(a)
    known[known] = a[at[known]] == b[known]
    a_counts[at[known]] += b_counts[known]
    values, counts = np.insert(a, at[~known], b[~known]), np.insert(a_counts, at[~known], b_counts[~known])
    return encode(values, counts, width)


def _build(batches: Iterator[pa.RecordBatch], bits: int, shard_bits: int) -> Iterator[pa.RecordBatch]:
    width = bits - shard_bits

    def full(parts: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(parts), return_counts=True)
        shard = values >> np.uint64(width) if width < 64 else np.zeros(len(values), np.uint64)
        cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(values)]
        low = values & np.uint64((1 << width) - 1)
        filters = [encode(low[i:j], counts[i:j], width) for i, j in zip(cuts, cuts[1:], strict=False)]
        shards = pa.array(shard[cuts[:-1]].astype(np.int32))
        return pa.RecordBatch.from_arrays([shards, pa.array(filters, pa.binary())], ["shard", "filter"])

    parts, n = [], 0
    for batch in batches:
        parts.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
        n += batch.num_rows
        if n >= FILL:
            yield full(parts)
            parts, n = [], 0
    if n:
        yield full(parts)


def filters(fingerprints: DataFrame, shard_bits: int, bits: int = BITS) -> DataFrame:
    """shard, filter: the counting quotient filters of each partition of a column of fingerprints."""
    return fingerprints.mapInArrow(lambda b: _build(b, bits, shard_bits), "shard int, filter binary")


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Filters of a shard follow one another; as with carries of a binary number, equal levels merge."""

    def done(shard: int, stack: list[tuple[int, bytes]]) -> pa.RecordBatch:
        while len(stack) > 1:
            (_, a), (level, b) = stack.pop(), stack.pop()
            stack.append((level, merge(b, a)))
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([stack[0][1]])], ["shard", "filter"])

    now, stack = None, []
    for batch in batches:
        for shard, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if shard != now and stack:
                yield done(now, stack)
                stack = []
            now, level, data = shard, 0, data.as_py()
            while stack and stack[-1][0] == level:
                level, data = level + 1, merge(stack.pop()[1], data)
            stack.append((level, data))
    if stack:
        yield done(now, stack)


def merged(parts: DataFrame) -> DataFrame:
    """shard, filter: one filter per shard, with the counts of all partitions."""
    return parts.repartition("shard").sortWithinPartitions("shard").mapInArrow(_merge, parts.schema)


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            values, counts, width = decode(data.as_py())
            more = counts > 1
            high = np.uint64(shard << width if width < 64 else 0)
            found = [pa.array((values[more] | high).view(np.int64)), pa.array(counts[more].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(found, ["fingerprint", "n"])


def repeated(whole: DataFrame) -> DataFrame:
    """fingerprint, n: the fingerprints that one filter per shard counts more than once."""
    return whole.mapInArrow(_repeated, "fingerprint long, n long")


def normalised(text: str | Column = "text") -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _texts(docs: DataFrame, bits: int) -> DataFrame:
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(docs["text"]).alias("text"))
    fingerprint = F.xxhash64("text")
    if bits < BITS:
        fingerprint = fingerprint.bitwiseAND(F.lit((1 << bits) - 1))
    return plain.withColumn("fingerprint", fingerprint)


def groups(docs: DataFrame, rows: DataFrame, n_rows: int, bits: int = BITS, most: int = BROADCAST_ROWS) -> DataFrame:
    """fingerprint, text_sha256, keep_id, group_size of the texts that occur more than once."""
    shard_bits = min(bits, 16, max(6, (n_rows // SHARD_ROWS).bit_length()))
    whole = merged(filters(rows.select("fingerprint"), shard_bits, bits))
    suspects = folders.written(repeated(whole).select("fingerprint"), "repeated-fingerprints")
    texts = _texts(docs, bits)
    if suspects.count() <= most:
        texts = texts.join(F.broadcast(suspects), "fingerprint", "left_semi")
    same = texts.groupBy("fingerprint", "text").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    found = same.where("group_size > 1")
    return found.select("fingerprint", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")


def exact_duplicates(
    docs: DataFrame, bits: int = BITS, most: int = BROADCAST_ROWS, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of each row of docs (doc_id, text)."""
    hashed = _texts(docs, bits).select("doc_id", "fingerprint", F.sha2("text", 256).alias("text_sha256"))
    rows = folders.written(hashed, "fingerprints")
    n_rows = rows.count()
    known = folders.written(groups(docs, rows, n_rows, bits, most), "equal-texts")
    key = ["fingerprint", "text_sha256"]
    large = F.col("group_size") > max(rows_per_task, n_rows * MIN_SHARE)  # fewer than 100,000 groups can be
    hot = known.where(large).select(*(F.col(c).alias(f"hot_{c}") for c in known.columns))
    rest = known.where(~large).select(*(F.col(c).alias(f"own_{c}") for c in known.columns))
    met = rows.join(F.broadcast(hot), [F.col(c) == F.col(f"hot_{c}") for c in key], "left")
    is_hot, is_own = F.col("hot_fingerprint").isNotNull(), F.col("own_fingerprint").isNotNull()
    dealt = F.xxhash64("doc_id", F.spark_partition_id())
    met = met.withColumn("route", F.when(is_hot, dealt).otherwise(F.col("fingerprint")))
    on = [F.col("route") == F.col("own_fingerprint"), F.col("text_sha256") == F.col("own_text_sha256")]
    joined = met.join(rest, on, "left")

    def chosen(name: str, alone: Column) -> Column:
        return F.when(is_hot, F.col(f"hot_{name}")).when(is_own, F.col(f"own_{name}")).otherwise(alone).alias(name)

    found = joined.select(
        "doc_id", chosen("keep_id", F.col("doc_id")), chosen("group_size", F.lit(1).cast("long")), "text_sha256"
    )
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    return found.select("doc_id", "keep_id", "group_size", kept, "text_sha256")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all columns; of rows that repeat doc_id and text one."""
    staying = exact_duplicates(docs).where("kept").select(
        F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_sha256")
    )
    named = docs.withColumn("_sha256", F.sha2(normalised(docs["text"]), 256))
    same = named["doc_id"].cast("long").eqNullSafe(staying["_kept_id"]) & (named["_sha256"] == staying["_kept_sha256"])
    once = named.join(staying.distinct(), same, "left_semi").dropDuplicates(["doc_id", "_sha256"])
    return once.select(docs.columns)
