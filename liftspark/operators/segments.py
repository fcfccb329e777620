"""One logistic regression per segment, all segments in the same jobs.

Each step of Newton's method is one grouped aggregation: a row adds its part of its segment's normal equations, tasks add up
what they read, and only sums per segment are shuffled, so a segment that holds most rows is no slower than others. The small
equations are solved in batches where the sums meet.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftspark.session import checkpointed

#: Numbers of a table of coefficients that a join may broadcast.
BROADCAST_NUMBERS = 2_000_000
#: A step is halved until no coefficient moves further.
LONGEST = 5.0


def _joined(rows: DataFrame, weights: DataFrame, width: int) -> DataFrame:
    small = weights.limit(BROADCAST_NUMBERS // width + 1).count() * width <= BROADCAST_NUMBERS
    return rows.join(F.broadcast(weights) if small else weights, "_key", "left")


def _linear(names: Sequence[str], weights: str) -> Column:
    out = F.element_at(weights, 1)
    for i, name in enumerate(names, 2):
        out = out + F.element_at(weights, i) * F.col(name)
    return out


def _solve(width: int, penalty: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    upper = np.triu_indices(width)
    slopes = np.diag([0.0] + [1.0] * (width - 1)) * penalty
    for batch in batches:
        old, gradient, half = (
            batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) for c in ("weights", "gradient", "curvature")
        )
        whole = np.zeros((batch.num_rows, width, width))
        whole[:, *upper] = half
        whole[:, upper[1], upper[0]] = half
        whole += slopes
        # directions that the rows of a segment leave open get no step
        step = np.einsum("nij,nj->ni", np.linalg.pinv(whole, rcond=1e-12, hermitian=True), gradient - old @ slopes)
        size = np.abs(step).max(axis=1, initial=0.0)
        step *= np.minimum(1.0, LONGEST / np.maximum(size, 1e-300))[:, None]
        new = old + step
        ends = pa.array(np.arange(0, new.size + 1, width), pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.ListArray.from_arrays(ends, pa.array(new.ravel())), pa.array(size)], names=["_key", "weights", "moved"])


def fit_logistic_by(
    df: DataFrame, keys: Sequence[str], features: Sequence[str], label: str, penalty: float = 1e-6, max_steps: int = 50, tolerance: float = 1e-9
) -> DataFrame:
    """``keys, weights, n, responders``: intercept and slopes of each segment, by Newton's method until no weight moves.

    ``penalty`` is half the weight of the squared slopes and keeps segments that the features separate finite. Rows with a missing
    feature or label take no part; null keys form a segment. A segment of one class only ends at the most extreme intercept that
    ``max_steps`` reach. Hand in stored rows: every step reads them.
    """
    names, width = [f"_x{i}" for i in range(len(features))], len(features) + 1
    rows = df.select(
        F.struct(*[F.col(k) for k in keys]).alias("_key"),
        *[F.col(f"`{c}`").cast("double").alias(n) for c, n in zip(features, names)],
        F.col(f"`{label}`").cast("double").alias("_y"),
    )
    for name in (*names, "_y"):
        rows = rows.filter(F.col(name).isNotNull() & ~F.isnan(name))
    counted = rows.groupBy("_key").agg(F.count("*").alias("n"), F.sum("_y").cast("long").alias("responders"))
    known = checkpointed(counted)
    weights = known.select("_key", F.array_repeat(F.lit(0.0), width).alias("weights"))
    kind = known.schema["_key"].dataType.simpleString()
    terms = [F.lit(1.0), *[F.col(n) for n in names]]
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    for _ in range(max_steps):
        scored = _joined(rows, weights, width).withColumn("_p", 1 / (1 + F.exp(-_linear(names, "weights"))))
        sums = scored.groupBy("_key").agg(
            F.first("weights").alias("weights"),
            F.array(*[F.sum(t * (F.col("_y") - F.col("_p"))) for t in terms]).alias("gradient"),
            F.array(*[F.sum(terms[i] * terms[j] * F.col("_p") * (1 - F.col("_p"))) for i, j in pairs]).alias("curvature"),
        )
        solved = checkpointed(sums.mapInArrow(lambda b: _solve(width, penalty, b), f"_key {kind}, weights array<double>, moved double"))
        weights = solved.select("_key", "weights")
        if (solved.agg(F.max("moved")).first()[0] or 0.0) <= tolerance:
            break
    return known.join(weights, "_key").select(*[F.col("_key").getField(k).alias(k) for k in keys], "weights", "n", "responders")


def score_by(df: DataFrame, model: DataFrame, keys: Sequence[str], features: Sequence[str], output: str = "score") -> DataFrame:
    """Adds the probability that the model of the row's segment gives; null where there is none."""
    names = [f"_x{i}" for i in range(len(features))]
    rows = df.withColumns({"_key": F.struct(*[F.col(k) for k in keys]), **{n: F.col(f"`{c}`").cast("double") for c, n in zip(features, names)}})
    weights = model.select(F.struct(*[F.col(k) for k in keys]).alias("_key"), F.col("weights").alias("_weights"))
    joined = _joined(rows, weights, len(features) + 1)
    return joined.withColumn(output, 1 / (1 + F.exp(-_linear(names, "_weights")))).drop("_key", "_weights", *names)
