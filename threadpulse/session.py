"""Session settings the library relies on."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Runtime-settable defaults. Shuffle partitions are left to the deployment: the
# cluster sets a high number and adaptive execution coalesces from there.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Read at start only. Checkpoint files go when nothing refers to them any more.
STATIC_CONF = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}


def build_session(
    app_name: str = "threadpulse",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **STATIC_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Windows, slots and labels are all defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable.

    The cluster names a shared folder in ``spark.checkpoint.dir``; where it does
    not, the warehouse is one.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
    sc.setCheckpointDir(shared)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path that the driver and all executors see, beside the checkpoints."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
