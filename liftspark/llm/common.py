"""What the operators of this folder share: stored tables, checked broadcasts, bounded Arrow chunks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftspark.session import scratch_root

#: Rows of fixed-width numbers that a broadcast may hold (about 100 MB as a hash table).
BROADCAST_ROWS = 1_000_000
#: Bytes of text that are turned into arrays at once.
CHUNK_BYTES = 2_000_000


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{scratch_root(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


#: Drops the shuffle files of a query once it has ended; otherwise they stay until the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, survives lost executors.

    The write's shuffle files go with its end, as nothing reads them again.
    """
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint if ``df`` has at most ``max_rows`` rows, else ``df`` for a shuffled join.

    For narrow tables of numbers only, so that a bound on rows bounds the bytes.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, made longer where ``df`` has such columns."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column``; a longer text comes alone."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        first = total = 0
        for i, n in enumerate(lengths.tolist()):
            if total and total + n > limit:
                yield batch.slice(first, i - first)
                first, total = i, 0
            total += n
        if first < batch.num_rows:
            yield batch.slice(first)
