"""Tables with a folder per day, so that a window or a row cap reads the days it needs.

``day`` is the UTC date of an event time, or of the start of a window; rows without one lie in a folder of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from threadpulse.session import use_utc


def write_days(df: DataFrame, path: str, at: str | Column = "ts") -> None:
    """Write the rows by day; days that occur in them are replaced, others stay.

    A day is written by as many tasks as its rows need: adaptive execution parts large ones.
    """
    use_utc(df.sparkSession)
    dated = df.withColumn("day", F.to_date(at))
    writer = dated.hint("rebalance", F.col("day")).write.mode("overwrite").partitionBy("day")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def read_days(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table with the columns of schema and ``day``."""
    use_utc(spark)
    return spark.read.schema(StructType(list(schema)).add("day", DateType())).parquet(path)


def between(table: DataFrame, start_ms: int, end_ms: int, ts: str = "ts") -> DataFrame:
    """Rows with event time from start (included) to end (excluded); other days are not read."""
    start, end = F.timestamp_millis(F.lit(start_ms)), F.timestamp_millis(F.lit(end_ms))
    days = F.col("day").between(F.to_date(start), F.to_date(end))
    return table.where(days & (F.col(ts) >= start) & (F.col(ts) < end))


def first_rows(table: DataFrame, n: int, ts: str = "ts", *keys: str) -> DataFrame:
    """The first n rows in order of event time and keys, read from the days that hold them.

    Counts per day need no column of the files. The last day needed becomes a filter on the folders while the
    query runs.
    """
    counts = table.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    earlier = F.sum("n").over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1))
    needed = counts.withColumn("earlier", F.coalesce(earlier, F.lit(0))).where(F.col("earlier") < n)
    last = needed.agg(F.max("day").alias("last")).scalar()
    early = table.where(F.col("day").isNull() | (F.col("day") <= last))
    return early.orderBy(ts, *keys).limit(n).select([c for c in table.columns if c != "day"])
