"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}

_local_scratch: str | None = None


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("liftspark")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a session whose executors run in the driver's process may do without the
    setting; elsewhere a folder of one machine cannot be read by all, so there it is an error.
    """
    global _local_scratch
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="liftspark-")
    return _local_scratch


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{scratch_root(spark).rstrip('/')}/liftspark/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and return the stored copy."""
    path = scratch_path(df.sparkSession, "checkpoint")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, *keys: str, rows: int, least: int = 1) -> DataFrame:
    """``df`` dealt by its keys to as many partitions as keep each at about ``rows`` rows, at least ``least``.

    Splits of files and adaptive execution go by compressed bytes, which say little of what a task holds once it sorts or
    caches the rows. Counts the rows first: hand in stored rows or a cheap plan.
    """
    return df.repartition(max(least, -(-df.count() // rows)), *keys)
