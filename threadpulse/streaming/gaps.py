"""Gaps between consecutive comments of a key, on a stream.

Comments of a key wait in state until the watermark has passed them, so that they leave in order of event time and
id; what is kept of the past is the last one that left. Rows behind the watermark are dropped, as everywhere.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from threadpulse.streaming import packs


class _Ordered(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", packs.SCHEMA)  # (at, comment_id)
        self.first = handle.getValueState("first", "at_ms bigint")  # when the next timer fires
        self.last = handle.getValueState("last", "at bigint")

    def handleInputRows(self, key: Any, rows: Iterable[Row], timerValues: Any) -> Iterator[Row]:
        due = self.first.get()[0] if self.first.exists() else None
        earliest, new = due, []
        for row in rows:
            new.append((row["at"], row["comment_id"]))
            at_ms = -(-row["at"] // 1000)
            earliest = at_ms if earliest is None else min(earliest, at_ms)
            if len(new) >= packs.SIZE:
                self.waiting.appendValue(packs.pack(new))
                new = []
        if new:
            self.waiting.appendValue(packs.pack(new))
        self._wake(due, earliest)
        return iter(())

    def _wake(self, due: int | None, earliest: int | None) -> None:
        if due != earliest:
            if due is not None:
                self.handle.deleteTimer(due)
            if earliest is not None:
                self.handle.registerTimer(earliest)
                self.first.update((earliest,))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        rows = sorted(packs.unpacked(self.waiting))
        out = [r for r in rows if r[0] <= passed]
        left = rows[len(out) :]
        previous = self.last.get()[0] if self.last.exists() else None
        for at, comment in out:
            yield Row(key=key[0], comment_id=comment, at=at, previous=previous)
            previous = at
        if out:
            self.last.update((previous,))
        if left:
            self.waiting.put([packs.pack(left[n : n + packs.SIZE]) for n in range(0, len(left), packs.SIZE)])
            self.first.clear()
            self._wake(None, -(-left[0][0] // 1000))
        else:
            self.waiting.clear()
            self.first.clear()

    def close(self) -> None:
        pass


def interarrival_gaps(comments: DataFrame, key: str = "user_id") -> DataFrame:
    """Streaming counterpart of ``operators.profile.interarrival_gaps`` for a key; needs a watermark on ``ts``."""
    key_type = comments.schema[key].dataType.simpleString()
    timed = comments.select(F.col(key).alias("key"), "comment_id", "ts", F.unix_micros("ts").alias("at"))
    ordered = timed.groupBy("key").transformWithState(
        _Ordered(), f"key {key_type}, comment_id bigint, at bigint, previous bigint", "append", "eventTime"
    )
    return ordered.select(
        F.col("key").alias(key),
        "comment_id",
        F.timestamp_micros("at").alias("ts"),
        ((F.col("at") - F.col("previous")) / 1_000_000).alias("gap_seconds"),
    )
