"""Gain tables and quantiles of scored rows that arrive part by part, a month at a time say.

A part is written once: its rows in order of score, and a histogram of them over fixed cells of the score. A table over any
parts adds up their histograms, which are small, and reads rows only of the few cells that an edge divides; as files are in order
of score, the scan skips the rest of them. Adding a part reads no other part. Results equal those over all rows at once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftspark.operators.gain import GAIN_EDGES, bands
from liftspark.operators.prefix import ordered_prefix


@dataclass(frozen=True)
class Cells:
    """Equal cells between two scores; what lies outside belongs to the first or the last. The same for all parts of a store."""

    low: float = 0.0
    high: float = 1.0
    number: int = 4096

    def edge(self, cell: int) -> float:
        return self.low + (self.high - self.low) * cell / self.number

    def of(self, score: str) -> F.Column:
        at = F.floor((F.col(score) - self.low) * (self.number / (self.high - self.low)))
        return F.greatest(F.lit(0), F.least(F.lit(self.number - 1), at)).cast("int")


def add_part(df: DataFrame, path: str, part: str, score: str = "score", label: str = "final_response", id: str = "jobid", cells: Cells = Cells()) -> None:
    """Write one part, in place of what it had before. Missing scores are an error, missing labels count as 0.

    Rows come first, then their histogram; a part whose writing was cut off is to be written again.
    """
    rows = df.select(F.col(id).alias("id"), F.col(score).cast("double").alias("score"), F.coalesce(F.col(label).cast("long"), F.lit(0)).alias("label"))
    wrong = rows.filter(F.col("score").isNull() | F.isnan("score"))
    if not wrong.isEmpty():
        raise ValueError(f"part {part!r} has missing scores")
    target = f"{path}/rows/part={part}"
    # ids too, so that a score which many rows share is written by several tasks
    rows.repartitionByRange("score", "id").sortWithinPartitions("score").write.mode("overwrite").parquet(target)
    kept = df.sparkSession.read.schema(rows.schema).parquet(target)
    found = kept.groupBy(cells.of("score").alias("cell")).agg(F.count("*").alias("n"), F.sum("label").alias("hits"))
    found.coalesce(1).write.mode("overwrite").parquet(f"{path}/cells/part={part}")  # a row a cell


def _histogram(spark: SparkSession, path: str, parts: Sequence[str] | None, cells: Cells) -> tuple[np.ndarray, np.ndarray]:
    """Rows and responders of each cell: as many numbers as there are cells reach the driver."""
    table = spark.read.option("basePath", f"{path}/cells").parquet(*([f"{path}/cells/part={p}" for p in parts] if parts else [f"{path}/cells"]))
    n, hits = np.zeros(cells.number, np.int64), np.zeros(cells.number, np.int64)
    for cell, a, b in table.groupBy("cell").agg(F.sum("n"), F.sum("hits")).collect():
        n[cell], hits[cell] = a, b
    return n, hits


def _rows(spark: SparkSession, path: str, parts: Sequence[str] | None, wanted: Sequence[int], cells: Cells) -> DataFrame:
    """The rows of some cells. Ranges of scores, a little wide, let the scan skip files; cells decide."""
    table = spark.read.option("basePath", f"{path}/rows").parquet(*([f"{path}/rows/part={p}" for p in parts] if parts else [f"{path}/rows"]))
    margin = (cells.high - cells.low) / cells.number / 1000
    near = F.lit(False)
    for c in wanted:
        inside = F.lit(True)
        if c > 0:
            inside = inside & (F.col("score") >= cells.edge(c) - margin)
        if c < cells.number - 1:
            inside = inside & (F.col("score") <= cells.edge(c + 1) + margin)
        near = near | inside
    return table.filter(near).withColumn("cell", cells.of("score")).filter(F.col("cell").isin(list(wanted)))


def at_ranks(spark: SparkSession, path: str, ranks: Sequence[int], parts: Sequence[str] | None = None, cells: Cells = Cells()) -> tuple[list[tuple[int, float | None]], int, int]:
    """For each rank from the top, the responders down to it and the score there (null where no row had to be read); rows and responders in all."""
    n, hits = _histogram(spark, path, parts, cells)
    down, down_hits = np.cumsum(n[::-1]), np.cumsum(hits[::-1])
    out: list[tuple[int, float | None]] = [(0, None)] * len(ranks)
    inside: dict[tuple[int, int], list[int]] = {}
    for i, rank in enumerate(ranks):
        if rank <= 0:
            continue
        at = int(np.searchsorted(down, rank))  # cells from the top
        before, before_hits = (int(x[at - 1]) if at else 0 for x in (down, down_hits))
        if rank == down[at]:
            out[i] = (int(down_hits[at]), None)
        else:
            out[i] = (before_hits, None)
            inside.setdefault((cells.number - 1 - at, rank - before), []).append(i)
    if inside:
        wanted = sorted({c for c, _ in inside})
        ranked = ordered_prefix(_rows(spark, path, parts, wanted, cells).select("id", "score", "label", "cell"), "score", "id", ["cell"], ["label"])
        asked = spark.createDataFrame([(c, r - 1) for c, r in inside], "cell int, row_num long")
        for cell, rank, score, label in ranked.join(F.broadcast(asked), ["cell", "row_num"]).select("cell", "row_num", "score", "cum_label").collect():
            for i in inside[cell, rank + 1]:
                out[i] = (out[i][0] + label, score)
    return out, int(n.sum()), int(hits.sum())


def gain_table_of(spark: SparkSession, path: str, edges: Sequence[float] = GAIN_EDGES, parts: Sequence[str] | None = None, cells: Cells = Cells()) -> DataFrame:
    """The gain table over all parts, or some: the one that ``gain_table`` makes of all their rows."""
    n, _ = _histogram(spark, path, parts, cells)
    size = int(n.sum())
    ranks = [math.ceil(float(e) * float(size)) for e in edges]
    found, _, total = at_ranks(spark, path, ranks, parts, cells)
    if not total:
        raise ValueError("no row has a positive label")
    at = [(i, rank, size, total, cum) for i, (rank, (cum, _)) in enumerate(zip(ranks, found))]
    return bands(spark.createDataFrame(at, "cut int, rank long, n long, total long, cum long"), edges)


def quantiles_of(spark: SparkSession, path: str, shares: Sequence[float], parts: Sequence[str] | None = None, cells: Cells = Cells()) -> list[float]:
    """The score of the row at ``ceil(share * n)`` from the bottom, at least the first, for each share."""
    n, _ = _histogram(spark, path, parts, cells)
    size = int(n.sum())
    if not size:
        raise ValueError("there are no rows")
    ranks = [size + 1 - min(size, max(1, math.ceil(s * size))) for s in shares]
    found, _, _ = at_ranks(spark, path, ranks, parts, cells)
    down = np.cumsum(n[::-1])
    # a rank at the end of a cell is its least score, which the rows of that cell tell
    ends = {i: cells.number - 1 - int(np.searchsorted(down, rank)) for i, (rank, (_, score)) in enumerate(zip(ranks, found)) if score is None}
    least: dict[int, float] = {}
    if ends:
        rows = _rows(spark, path, parts, sorted(set(ends.values())), cells)
        least = dict(rows.groupBy("cell").agg(F.min("score")).collect())
    return [least[ends[i]] if i in ends else found[i][1] for i in range(len(shares))]
