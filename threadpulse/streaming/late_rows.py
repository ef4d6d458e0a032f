"""Rows that a watermark dropped, as a table.

A listener writes one row for each trigger and stateful step in which rows came too late. Spark counts them where
a step drops them: rows for an aggregate after its partial sums, so equal keys of a task and window count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = "query string, run string, name string, batch bigint, triggered string, step int, operator string, dropped bigint"


class LateRows(StreamingQueryListener):
    """Counts dropped rows of all queries of a session, or of those in ``queries``, below a path.

    Each trigger has a folder of its own, so a trigger that is reported again replaces its rows.
    """

    def __init__(self, spark: SparkSession, path: str, queries: set[str] | None = None) -> None:
        self.spark, self.path, self.queries = spark, path.rstrip("/"), queries

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if self.queries is not None and str(progress.id) not in self.queries:
            return
        # Steps are reported from the last to the first; number them along the data.
        steps = enumerate(reversed(progress.stateOperators))
        rows = [
            (
                str(progress.id),
                str(progress.runId),
                progress.name,
                progress.batchId,
                progress.timestamp,
                step,
                operator.operatorName,
                operator.numRowsDroppedByWatermark,
            )
            for step, operator in steps
            if operator.numRowsDroppedByWatermark
        ]
        if rows:
            # The trigger time tells a batch without data from the batch of data with the same number.
            at = "".join(c for c in progress.timestamp if c.isdigit())
            found = self.spark.createDataFrame(rows, SCHEMA).coalesce(1)
            found.write.mode("overwrite").json(f"{self.path}/query={progress.id}/batch={progress.batchId}-{at}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def record_late_rows(spark: SparkSession, path: str, queries: set[str] | None = None) -> LateRows:
    """Begin to record; ``spark.streams.removeListener`` ends it."""
    listener = LateRows(spark, path, queries)
    spark.streams.addListener(listener)
    return listener


def read_late_rows(spark: SparkSession, path: str) -> DataFrame:
    """The recorded rows."""
    return spark.read.schema(SCHEMA).json(f"{path.rstrip('/')}/query=*/batch=*")


def totals(late: DataFrame) -> DataFrame:
    """Rows dropped by each query and step so far."""
    return late.groupBy("query", "step", "operator").agg({"dropped": "sum"}).withColumnRenamed("sum(dropped)", "dropped")
