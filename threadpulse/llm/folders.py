"""Folders that the driver and all executors see."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below spark.checkpoint.dir, or below the warehouse where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


#: Lets go of the shuffle files of a query when it has ended.
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in a shared folder: computed once, and read again if an executor is lost.

    The shuffle files from which the table was made go as soon as it is there.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    before = spark.conf.get(_RELEASE, "false")
    spark.conf.set(_RELEASE, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)
