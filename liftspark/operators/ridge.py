"""Ridge regression and its grid search from moments.

One aggregation gives, for each fold, the counts, sums and products of the columns. The moments of a training set are those of
all folds less its own, so every penalty and choice of features on every fold is solved, and judged, without another pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftspark.operators.sampling import with_fold

SCORES_SCHEMA = "trial int, fold int, loss double"


@dataclass(frozen=True)
class RidgePoint:
    """A penalty on the squares of the slopes, and the features that take part. The intercept is free."""

    penalty: float
    features: tuple[str, ...]


@dataclass(frozen=True)
class Moments:
    """Count, mean and centred products of some columns, the label last."""

    n: float
    mean: np.ndarray
    products: np.ndarray

    def __add__(self, other: "Moments") -> "Moments":
        n = self.n + other.n
        apart = other.mean - self.mean
        share = other.n / n if n else 0.0
        return Moments(n, self.mean + apart * share, self.products + other.products + np.outer(apart, apart) * self.n * share)

    def of(self, at: Sequence[int]) -> "Moments":
        return Moments(self.n, self.mean[list(at)], self.products[np.ix_(at, at)])


def moments(df: DataFrame, columns: Sequence[str], fold: str) -> dict[int, Moments]:
    """The moments of each fold, over rows without a missing value: one row a fold reaches the driver."""
    names = [f"c{i}" for i in range(len(columns))]
    rows = df.select(F.col(fold).alias("fold"), *[F.col(f"`{c}`").cast("double").alias(n) for c, n in zip(columns, names)])
    known = [F.col(n).isNotNull() & ~F.isnan(n) for n in names]
    for condition in known:
        rows = rows.filter(condition)
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    # covariances are centred as they are added up, which sums of squares are not
    products = [F.covar_pop(names[i], names[j]).alias(f"p{i}_{j}") for i, j in pairs]
    out = {}
    for row in rows.groupBy("fold").agg(F.count("*").alias("n"), *[F.avg(n).alias(f"m{i}") for i, n in enumerate(names)], *products).collect():
        grid = np.zeros((len(names), len(names)))
        for i, j in pairs:
            grid[i, j] = grid[j, i] = row[f"p{i}_{j}"] * row["n"]
        out[row["fold"]] = Moments(row["n"], np.array([row[f"m{i}"] for i in range(len(names))]), grid)
    return out


def solve(m: Moments, penalty: float) -> tuple[np.ndarray, float]:
    """Slopes and intercept; of slopes that the data leave open, the shortest."""
    inner = m.products[:-1, :-1] + penalty * np.eye(len(m.mean) - 1)
    slopes = np.linalg.lstsq(inner, m.products[:-1, -1], rcond=None)[0]
    return slopes, float(m.mean[-1] - slopes @ m.mean[:-1])


def squared_error(m: Moments, slopes: np.ndarray, intercept: float) -> float:
    """The mean squared error on the rows of these moments."""
    turn = np.append(-slopes, 1.0)
    return float(turn @ m.products @ turn / m.n + (turn @ m.mean - intercept) ** 2)


def cross_validate(df: DataFrame, label: str, id: str, points: Sequence[RidgePoint], folds: int = 5, hash_fn: str = "murmur3") -> DataFrame:
    """``trial, fold, loss``: the mean squared error of each point on each fold by row id. A fold without rows is left out."""
    columns = [*dict.fromkeys(c for p in points for c in p.features), label]
    by_fold = moments(with_fold(df, id, folds, hash_fn), columns, "fold")
    out = []
    for fold, own in sorted(by_fold.items()):
        rest = [m for f, m in sorted(by_fold.items()) if f != fold]
        if not rest:
            continue
        total = rest[0]
        for m in rest[1:]:
            total = total + m
        for trial, point in enumerate(points):
            at = [columns.index(c) for c in (*point.features, label)]
            out.append((trial, fold, squared_error(own.of(at), *solve(total.of(at), point.penalty))))
    return df.sparkSession.createDataFrame(out, SCORES_SCHEMA)
