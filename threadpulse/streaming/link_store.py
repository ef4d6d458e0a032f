"""A lasting table of links, kept up to date by a stream; the last copy of a comment in event time wins.

The table holds one row for each comment of depth 1 and for each pair of a depth-2 comment and its parent. A
micro-batch is reduced to such rows and written as a delta in a folder named by the query and the batch, so a batch
that runs again replaces its own delta. From time to time a snapshot takes in all deltas; a small list beside the
snapshots says up to which batch of which query each goes, and is written when the snapshot is complete. Readers take
the newest listed snapshot and the deltas after it. Replaced snapshots and deltas stay until the next snapshot, for
readers that have begun. Rows lie in buckets by id, so a lookup of few ids reads few files.

Any job and session can read the table: ``read`` gives comments that ``operators.threads`` turns into links.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from threadpulse.operators import threads
from threadpulse.operators.filters import valid_users

BUCKETS = 64
SNAPSHOT_EVERY = 20
COLUMNS = "comment_id bigint, depth int, in_reply_to bigint, user_id bigint, ts timestamp"
_KEY = ["comment_id", "depth", "in_reply_to"]


def latest(comments: DataFrame) -> DataFrame:
    """One row per link: the copy with the largest (ts, user_id)."""
    links = comments.where("depth IN (1, 2)").select(
        "comment_id",
        F.col("depth").cast("int").alias("depth"),
        F.when(F.col("depth") == 2, F.col("in_reply_to")).alias("in_reply_to"),
        "user_id",
        "ts",
    )
    last = F.max(F.struct("ts", "user_id")).alias("last")
    return links.groupBy(*_KEY).agg(last).select(*_KEY, "last.user_id", "last.ts")


def _bucket() -> F.Column:
    return F.pmod(F.xxhash64("comment_id"), F.lit(BUCKETS)).cast("int")


class LinkStore:
    """The table below a path that all executors share."""

    def __init__(self, spark: SparkSession, path: str, snapshot_every: int = SNAPSHOT_EVERY) -> None:
        self.spark, self.path, self.snapshot_every = spark, path.rstrip("/"), snapshot_every

    # --- files

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return root.getFileSystem(conf), jvm.org.apache.hadoop.fs.Path

    def _folders(self, name: str) -> list[str]:
        fs, path = self._fs()
        at = path(f"{self.path}/{name}")
        return sorted(f.getPath().getName() for f in fs.listStatus(at)) if fs.exists(at) else []

    def _remove(self, name: str) -> None:
        fs, path = self._fs()
        fs.delete(path(f"{self.path}/{name}"), True)

    def _deltas(self) -> list[tuple[str, int]]:
        """(query, batch) of every complete delta."""
        found = []
        for query in self._folders("delta"):
            batches = self._folders(f"delta/{query}")
            found += [(query, int(b)) for b in batches if "_SUCCESS" in self._folders(f"delta/{query}/{b}")]
        return found

    def _snapshots(self) -> dict[int, dict[str, int]]:
        """Version of each listed snapshot -> the last batch of each query in it."""
        versions = [v for v in self._folders("list") if "_SUCCESS" in self._folders(f"list/{v}")]
        out: dict[int, dict[str, int]] = {}
        for version in versions[-2:]:
            rows = self.spark.read.schema("query string, batch bigint").parquet(f"{self.path}/list/{version}").collect()
            out[int(version)] = {r["query"]: r["batch"] for r in rows}
        return out

    # --- reading

    def read(self, ids: Iterable[int] | None = None) -> DataFrame:
        """The links as comments (comment_id, depth, in_reply_to, user_id, ts); with ids those alone."""
        snapshots = self._snapshots()
        newest = max(snapshots, default=None)
        done = snapshots.get(newest, {})
        return self._merged(newest, [d for d in self._deltas() if d[1] > done.get(d[0], -1)], ids)

    def _merged(self, version: int | None, deltas: list[tuple[str, int]], ids: Iterable[int] | None = None) -> DataFrame:
        paths = [f"{self.path}/delta/{query}/{batch:010d}" for query, batch in deltas]
        paths += [f"{self.path}/snapshot/{version:010d}"] if version is not None else []
        if not paths:
            return self.spark.createDataFrame([], COLUMNS)
        wanted = None
        if ids is not None:
            wanted = self.spark.createDataFrame([(i,) for i in ids], "comment_id bigint")
            buckets = [r[0] for r in wanted.select(_bucket()).distinct().collect()]
        parts = []
        for path in paths:
            part = self.spark.read.schema(f"{COLUMNS}, bucket int").parquet(path)
            parts.append(part if wanted is None else part.where(F.col("bucket").isin(buckets)))
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        if wanted is not None:
            rows = rows.join(wanted, "comment_id", "left_semi")
        return latest(rows)

    def links(self) -> DataFrame:
        """Depth-1 comment -> author."""
        return threads.latest_links(self.read())

    def link_records(self) -> DataFrame:
        """Known comments as text records, resolved with the authors that their roots have now."""
        return threads.link_records(self.read())

    # --- writing

    def merge(self, comments: DataFrame, query: str, batch: int) -> None:
        """Take in the comments of a micro-batch; the same batch again changes nothing."""
        rows = latest(valid_users(comments)).withColumn("bucket", _bucket())
        writer = rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket")
        writer.parquet(f"{self.path}/delta/{query}/{batch:010d}")
        if (batch + 1) % self.snapshot_every == 0:
            self.snapshot()

    def snapshot(self) -> None:
        """Write a new snapshot of everything, and drop what the one before it had replaced."""
        old = self._snapshots()
        newest = max(old, default=None)
        done = old.get(newest, {})
        deltas = [d for d in self._deltas() if d[1] > done.get(d[0], -1)]
        if not deltas:
            return
        version = 0 if newest is None else newest + 1
        rows = self._merged(newest, deltas).withColumn("bucket", _bucket()).repartition("bucket")
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/snapshot/{version:010d}")
        upto = done | {q: max(b for x, b in deltas if x == q) for q, _ in deltas}
        listed = self.spark.createDataFrame([Row(query=q, batch=b) for q, b in upto.items()], "query string, batch bigint")
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/list/{version:010d}")
        for earlier in self._folders("snapshot"):
            if newest is not None and int(earlier) < newest:
                self._remove(f"list/{earlier}")
                self._remove(f"snapshot/{earlier}")
        for query, batch in self._deltas():
            if batch <= done.get(query, -1):
                self._remove(f"delta/{query}/{batch:010d}")


def keep_links(
    comments: DataFrame,
    path: str,
    checkpoint: str,
    snapshot_every: int = SNAPSHOT_EVERY,
    available_now: bool = True,
) -> StreamingQuery:
    """Keep the table of links at path up to date with a stream of comments."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # The id of the query is kept in its checkpoint, so it is the same after a restart.
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        LinkStore(batch.sparkSession, path, snapshot_every).merge(batch, query, batch_id)

    writer = comments.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
