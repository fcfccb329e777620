"""Table writes and small exports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftspark.session import checkpointed


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    df.write.format(fmt).mode(mode).save(path)


def write_partitioned(
    df: DataFrame, path: str, partition: str, fmt: str = "parquet", max_records_per_file: int = 0
) -> None:
    """Write one folder per value, with few files each.

    Rebalancing gathers the rows of a value like a repartition by it, but splits
    values that hold far more rows than others over several tasks.
    """
    (
        df.hint("rebalance", partition)
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(partition)
        .save(path)
    )


def export_single_csv(df: DataFrame, path: str) -> None:
    """Write a report as one CSV file with a header.

    The rows are written in parallel first, then copied by one task into the one file. An older report
    stays until the new one is complete.
    """
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.parts")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    checkpointed(df).repartition(1).write.option("header", True).csv(folder.toString())
    parts = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".csv")]
    older = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.old")
    replaced = fs.exists(target) and fs.rename(target, older)
    if not fs.rename(parts[0], target):
        if replaced:
            fs.rename(older, target)
        raise OSError(f"could not move the report to {path}")
    fs.delete(older, True)
    fs.delete(folder, True)


#: Characters of JSON text that a caller may hold.
JSON_LIMIT = 256 << 20


def json_records(df: DataFrame, limit: int = JSON_LIMIT) -> str:
    """The rows as one JSON array; rows arrive a partition at a time. A text beyond ``limit`` characters is an error: write such tables to files."""
    text = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    parts, size = [], 0
    for (row,) in df.select(text).toLocalIterator():
        size += len(row) + 2
        if size > limit:
            raise ValueError(f"more than {limit} characters of JSON; use write_json_records")
        parts.append(row)
    return "[" + ", ".join(parts) + "]"


def write_json_records(df: DataFrame, path: str) -> None:
    """The rows as files of one JSON object per line, written where they lie; nulls are kept."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
