"""Top-k per window inside the plan of a stream.

Closed windows of an aggregate are ranked in two more steps. Each (window, bucket of keys) keeps its k best rows in
state until the watermark has passed the window, and then hands them out; the window's lists, at most k rows a
bucket, are merged. So no step holds more than k rows per window and bucket, whatever the number of keys, and the
result is a stream that any sink takes.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from datetime import UTC, datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from threadpulse.operators.windows import Span, label_window

BUCKETS = 16


def _order(entry: tuple[int, Any]) -> tuple:
    """Largest value first, then the smallest key, NULL before all others."""
    value, key = entry
    return -value, key is not None, key


class _Best(StatefulProcessor):
    """The k best (value, key) of a window's bucket; handed out when the watermark passes the window."""

    def __init__(self, k: int, key_type: str) -> None:
        self.k, self.key_type = k, key_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", f"entries array<struct<value:bigint,key:{self.key_type}>>")

    def handleInputRows(self, key: Any, rows: Iterable[Row], timerValues: Any) -> Iterator[Row]:
        known = [tuple(e) for e in self.best.get()[0]] if self.best.exists() else []
        if not known:
            self.handle.registerTimer(key[0] // 1000)
        seen = ((row["value"], row["key"]) for row in rows)
        self.best.update((heapq.nsmallest(self.k, [*known, *heapq.nsmallest(self.k, seen, key=_order)], key=_order),))
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        entries = self.best.get()[0]
        self.best.clear()
        yield Row(at=datetime.fromtimestamp(0, UTC) + timedelta(microseconds=key[0]), entries=entries)

    def close(self) -> None:
        pass


def best_per_window(
    scored: DataFrame, span: Span, k: int, value: str, key: str, buckets: int = BUCKETS
) -> DataFrame:
    """Streaming counterpart of ``operators.ranking.top_k`` over (window, key, value) in append mode."""
    key_type = scored.schema[key].dataType.simpleString()
    bucketed = scored.select(
        F.window_time("window").alias("at"),
        F.unix_micros(F.window_time("window")).alias("at_us"),
        F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket"),
        F.col(value).cast("bigint").alias("value"),
        F.col(key).alias("key"),
    )
    entries = f"array<struct<value:bigint,key:{key_type}>>"
    best = bucketed.groupBy("at_us", "bucket").transformWithState(
        _Best(k, key_type), f"at timestamp, entries {entries}", "append", "eventTime", eventTimeColumnName="at"
    )
    merged = best.groupBy(span.column("at").alias("window")).agg(F.flatten(F.collect_list("entries")).alias("entries"))
    # Ascending order of (-value, key) is the ranking; NULL keys come first.
    ordered = F.array_sort(F.transform("entries", lambda e: F.struct((-e["value"]).alias("v"), e["key"].alias("key"))))
    ranked = label_window(merged.select("window", F.slice(ordered, 1, k).alias("top")))
    places = ranked.select("win_start_ms", F.posexplode("top").alias("place", "entry"))
    return places.select(
        "win_start_ms",
        (F.col("place") + 1).cast("bigint").alias("rk"),
        F.col("entry.key").alias(key),
        (-F.col("entry.v")).alias(value),
    )
