"""Streaming sources of raw lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def lines_from_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    group: str | None = None,
    starting: str = "latest",
    max_records: int | None = None,
) -> DataFrame:
    """Lines of a message topic; needs the Kafka connector package at deploy time."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if group:
        options["kafka.group.id"] = group
    if max_records:
        options["maxOffsetsPerTrigger"] = str(max_records)
    source = spark.readStream.format("kafka").options(**options).load()
    return source.select(F.col("value").cast("string").alias("value"), "timestamp")


def lines_from_folder(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of text files as they appear in a folder.

    ``max_files`` limits the files of a trigger. Set it only if the files come in event-time order: else
    the watermark of one trigger drops rows of the next as late.
    """
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    source = reader.text(path)
    return source.withColumn("timestamp", F.current_timestamp())
