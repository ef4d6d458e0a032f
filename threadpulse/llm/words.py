"""Words of whole texts as numpy arrays, for use on Arrow batches inside tasks.

A text column is read as its UTF-8 bytes. Separators are ASCII, so bytes can be classified without
decoding. NULL counts as the empty text. Hashes are polynomials over 64 bits with fixed keys, alike in
every task and run.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BATCH_BYTES = 1 << 20
WHITE = bytes([0x20, *range(0x09, 0x0E)])

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_STEP = 0xD1342543DE82EF95


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit values whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_powers = {_MULTIPLIER: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def _power(base: int, n: int) -> np.ndarray:
    if len(_powers[base]) < n:
        factors = np.full(max(n, 1 << 16), base, np.uint64)
        factors[0] = 1
        _powers[base] = np.cumprod(factors, dtype=np.uint64)
    return _powers[base][:n]


class Texts(NamedTuple):
    """Bytes of several texts; text i is data[bounds[i]:bounds[i + 1]]."""

    data: np.ndarray
    bounds: np.ndarray

    @staticmethod
    def of(column: pa.Array) -> Texts:
        column = pc.fill_null(column.cast(pa.large_string()), "")
        bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
        return Texts(data[bounds[0] : bounds[-1]], bounds - bounds[0])

    def lowered(self) -> Texts:
        """A-Z in lower case."""
        capital = (self.data >= 65) & (self.data <= 90)
        return Texts(self.data + capital.astype(np.uint8) * np.uint8(32), self.bounds)

    def flags(self, members: bytes) -> np.ndarray:
        table = np.zeros(256, bool)
        table[list(members)] = True
        return table[self.data]

    def per_text(self, counted: np.ndarray) -> np.ndarray:
        """Sums of a value per byte over each text."""
        total = np.concatenate([[0], np.cumsum(counted, dtype=np.int64)])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]


class Spans(NamedTuple):
    """Pieces of texts: byte ranges and the index of the text that each is from."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray

    def per_text(self, n: int) -> np.ndarray:
        return np.bincount(self.text, minlength=n)


def split(texts: Texts, separators: bytes) -> Spans:
    """Maximal runs of bytes that are no separators, in order."""
    inside = ~texts.flags(separators)
    n = len(inside)
    edge = np.zeros(n + 1, bool)
    edge[texts.bounds] = True
    before = np.concatenate([[False], inside[:-1]]) if n else inside
    after = np.concatenate([inside[1:], [False]]) if n else inside
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Spans(start, end, np.searchsorted(texts.bounds, start, "right") - 1)


def hashes(texts: Texts, spans: Spans, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each span's bytes; equal bytes have equal hashes wherever they stand."""
    letters = mix(np.arange(1, 257, dtype=np.uint64) + np.uint64(seed << 32))
    n = len(texts.data)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(letters[texts.data] * _power(_MULTIPLIER, n), out=total[1:])
    return mix((total[spans.end] - total[spans.start]) * _power(_INVERSE, n + 1)[spans.start])


def windows(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of values[i:i + width] for every i at which that many are left."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out *= np.uint64(_STEP)
        out += values[k : k + n]
    return mix(out)


def same_text(spans: Spans, width: int) -> np.ndarray:
    """Whether the window of width spans at i lies in one text."""
    n = max(0, len(spans.text) - width + 1)
    return spans.text[:n] == spans.text[width - 1 :][:n]


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into parts of about limit bytes of text, of one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
        for i, j in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(i, j - i)
