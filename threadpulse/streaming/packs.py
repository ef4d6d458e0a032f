"""Rows of a list in keyed state, many to an entry: each entry costs a call and a conversion of its own."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

from pyspark.sql.streaming.stateful_processor import ListState

SCHEMA = "rows binary"
#: Rows in an entry.
SIZE = 10_000


def pack(rows: list[tuple]) -> tuple[bytes]:
    return (pickle.dumps(rows),)


def unpacked(state: ListState) -> Iterator[tuple]:
    """All rows in the order in which they were appended."""
    for (rows,) in state.get():
        yield from pickle.loads(rows)
