"""Whitening of embeddings: leading principal components by Chebyshev-filtered subspace iteration.

The covariance matrix is never formed. One pass over the stored vectors gives ``Xᵀ(XQ)`` of the centred matrix ``X``
for a thin block ``Q``: every task multiplies the rows it reads and sends one small matrix. A round filters the block
with a Chebyshev polynomial in the covariance, which damps the spectrum below the block's least Ritz value and blows up
what lies above, then orthonormalises it (QR) and solves the small projected problem (Rayleigh-Ritz). Rounds go on until
the residuals of the wanted pairs are down to rounding, and a block with fresh random directions finds nothing larger.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftspark.llm.common import stored, unused

COMPONENTS = 8
#: Entries are kept as whole numbers ``floor(SCALE * c) + SHIFT``.
SCALE, SHIFT = 1024, 100_000
#: Directions beside the wanted ones, degree of the polynomial, rounds before the block grows.
GUARD, DEGREE, PATIENCE = 16, 10, 4
#: Residuals, relative to the largest eigenvalue, that certify a pair at most, and at which rounds end at once.
CERTIFIED, FLOOR = 1e-12, 2e-15
#: Components of a smaller share of the largest eigenvalue are rounding.
RANK = 1e-12
#: Rows that are multiplied at once; bytes of vectors in a stored part: between these, as cores allow.
CHUNK_ROWS, PART_BYTES = 8192, (1 << 20, 64 << 20)
#: Matrices of tasks are added up by so many tasks before the driver adds the rest.
ADDERS = 8
#: Whole numbers beyond this are not exact any more; larger entries count as it.
LARGEST = float(1 << 60)

Product = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Whitening:
    """``n`` vectors of sums ``total``; ``values`` and ``vectors`` (columns) are the leading eigenpairs of the covariance, ``trace`` its trace."""

    n: int
    total: np.ndarray
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    passes: int = 0

    def project(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.total) @ self.vectors / np.sqrt(self.values)


def whole(raw: np.ndarray) -> np.ndarray:
    """Entries as whole numbers."""
    return np.clip(np.floor(SCALE * raw), -LARGEST, LARGEST).astype(np.int64) + SHIFT


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """``x - total / n``, whole part first, so that large common parts leave no rounding."""
    low, rest = np.divmod(total, n)
    return (x - low).astype(float) - rest.astype(float) / n


def deviations(x: np.ndarray, n: int, total: np.ndarray) -> list[int | None]:
    """The exact sum over dimensions of ``(n * x - total)²`` of each row; null where a long can't hold it."""
    rough = (centred(x, n, total) ** 2).sum(axis=1) * float(n) ** 2
    if not len(rough) or rough.max() < 4e18:
        return ((n * (x - total // n) - total % n) ** 2).sum(axis=1).tolist()
    exact = [sum((n * int(v) - int(t)) ** 2 for v, t in zip(row, total)) for row in x]
    return [v if v < 1 << 63 else None for v in exact]


def prepared(vectors: DataFrame, id: str, vector: str) -> tuple[DataFrame, int, np.ndarray]:
    """``id, x`` of the vectors that take part, stored, with their number and the exact sums per dimension."""
    rows = vectors.select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    wrong = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = rows.filter(F.col("v").isNotNull() & ~wrong & (F.size("v") > 0)).withColumn("dim", F.size("v"))
    lengths = rows.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).first()
    if lengths is None:
        return rows.select("id", F.col("v").cast("array<long>").alias("x")), 0, np.zeros(0, np.int64)
    dim, n = lengths

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole(matrix(batch.column("v"), dim))
            ends = pa.array(np.arange(0, x.size + 1, dim), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], names=["id", "x"])

    kind = rows.schema["id"].dataType.simpleString()
    least, most = (-(-n * dim * 8 // size) for size in PART_BYTES[::-1])
    # a shuffle of the vectors alone, so that later passes read parts of one size
    even = rows.filter(F.col("dim") == dim).select("id", "v").repartition(max(least, min(most, vectors.sparkSession.sparkContext.defaultParallelism)))
    held = stored(even.mapInArrow(turn, f"id {kind}, x array<bigint>"), "whole-vectors")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dim, object)  # Python's whole numbers: no bound
        for batch in batches:
            x = matrix(batch.column("x"), dim)
            total += (x >> 31).sum(axis=0).astype(object) * (1 << 31) + (x & 0x7FFFFFFF).sum(axis=0).astype(object)
        yield pa.RecordBatch.from_pydict({"at": np.arange(dim), "total": pa.array([str(t) for t in total])})

    added = held.mapInArrow(sums, "at long, total string").groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    total = np.zeros(dim, object)
    for at, value in added.collect():  # one row a dimension
        total[at] = int(value)
    return held, n, total.astype(np.int64)


def summed(held: DataFrame, of: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum over all rows of ``of(x)``, a matrix of ``shape`` for each chunk ``x`` of rows.

    A task sends one matrix, a few tasks add these up in the order of tasks, the driver the rest: as many numbers as ``shape`` has, ``ADDERS`` times.
    """
    dim = shape[0]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(shape)
        for batch in batches:
            for i in range(0, batch.num_rows, CHUNK_ROWS):
                out += of(matrix(batch.slice(i, CHUNK_ROWS).column("x"), dim))
        yield pa.RecordBatch.from_pydict({"m": pa.array([out.tobytes()], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(shape)
        for batch in batches:
            for m in batch.column("m").to_pylist():
                out += np.frombuffer(m).reshape(shape)
        yield pa.RecordBatch.from_pydict({"m": pa.array([out.tobytes()], pa.binary())})

    parts = held.select("x").mapInArrow(multiply, "m binary")
    if held.rdd.getNumPartitions() > ADDERS:
        part = parts.withColumn("task", F.spark_partition_id())
        parts = part.repartition(ADDERS, "task").sortWithinPartitions("task").select("m").mapInArrow(add, "m binary")
    return sum((np.frombuffer(r.m).reshape(shape) for r in parts.collect()), np.zeros(shape))


def filtered(product: Product, q: np.ndarray, damped: float, largest: float, degree: int) -> np.ndarray:
    """The block times a Chebyshev polynomial that is small on ``[0, damped]`` and grows above, about 1 at ``largest``."""
    half = centre = damped / 2
    scale = first = half / (centre - largest)
    before, now = q, (product(q) - centre * q) * (scale / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - scale)
        before, now = now, (product(now) - centre * now) * (2 * after / half) - before * (scale * after)
        scale = after
    return now


def leading(product: Product, dim: int, k: int, guard: int = GUARD, degree: int = DEGREE) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenpairs of a positive semidefinite operator (fewer, if its rank is less), values falling.

    A block as wide as the space is solved at once, which bounds the rounds: the block grows while residuals stay too large.
    """
    random = np.random.default_rng(29)
    width = min(dim, k + guard)
    q = np.linalg.qr(random.standard_normal((dim, width)))[0]
    last, stuck, proven = np.inf, 0, None
    while True:
        image = product(q)
        values, turn = np.linalg.eigh((q.T @ image + image.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, image = q @ turn, image @ turn
        largest = max(values[0], 0.0)
        wanted = min(k, int((values > RANK * largest).sum())) if largest > 0 else 0
        if width == dim or not wanted:
            # the whole space, or nothing but zero
            if width == dim or largest == 0:
                return values[:wanted], q[:, :wanted]
        worst = np.linalg.norm(image[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max() / largest
        settled = worst <= FLOOR or (worst <= CERTIFIED and worst > last / 2)
        if settled and proven is not None and np.abs(values[:wanted] - proven[:wanted]).max() <= CERTIFIED * largest:
            return values[:wanted], q[:, :wanted]
        damped = max(values[-1], RANK * largest)
        if settled:  # fresh directions in place of those not wanted: whatever the block has missed shows in them
            proven, last, stuck = values, np.inf, 0
            fresh = random.standard_normal((dim, width - wanted))
            start = np.hstack([q[:, :wanted], fresh - q[:, :wanted] @ (q[:, :wanted].T @ fresh)])
        else:
            stuck = stuck + 1 if worst > last / 2 else max(0, stuck - 1)
            last = min(last, worst)
            start = q
            if stuck >= PATIENCE:
                wider = min(dim, width * 3 // 2)
                start = np.hstack([q, random.standard_normal((dim, wider - width))])
                width, last, stuck, proven = wider, np.inf, 0, None
        grown = filtered(product, np.linalg.qr(start)[0], damped, max(largest, damped * 1.0001), degree)
        # columns differ by many powers of ten after the filter
        q = np.linalg.qr(np.linalg.qr(grown / np.linalg.norm(grown, axis=0))[0])[0]


def fit(held: DataFrame, n: int, total: np.ndarray, k: int = COMPONENTS) -> Whitening:
    """The ``k`` leading components of the stored vectors (see ``prepared``)."""
    dim, passes = len(total), 0
    if not n:
        return Whitening(0, total, 0.0, np.zeros(0), np.zeros((0, 0)))

    def product(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def of(x: np.ndarray) -> np.ndarray:
            c = centred(x, n, total)
            return c.T @ (c @ q)

        return summed(held, of, (dim, q.shape[1])) / n

    trace = float(summed(held, lambda x: (centred(x, n, total) ** 2).sum(axis=0)[:, None], (dim, 1)).sum()) / n
    values, vectors = leading(product, dim, k)
    return Whitening(n, total, trace, values, vectors, passes)


def identity_error(held: DataFrame, fitted: Whitening) -> float:
    """The largest absolute entry of the covariance of the whitened vectors less the identity."""
    k, dim = len(fitted.values), len(fitted.total)

    def padded(m: np.ndarray) -> np.ndarray:
        return np.pad(m, ((0, dim - m.shape[0]), (0, 0)))

    mean = summed(held, lambda x: padded(fitted.project(x).sum(axis=0)[:, None]), (dim, 1))[:k, 0] / fitted.n

    def spread(x: np.ndarray) -> np.ndarray:
        w = fitted.project(x) - mean
        return padded(w.T @ w)

    return float(np.abs(summed(held, spread, (dim, k))[:k] / fitted.n - np.eye(k)).max())


def whitened(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error``: one row for each vector and leading component.

    Entries become whole numbers ``x``; ``deviation`` is the exact sum of ``(n * x - sums)²`` (null beyond a long), ``whitened`` the
    centred vector along the component over the root of its eigenvalue, ``explained`` the eigenvalue's share of the trace.
    Vectors that are null, empty or hold null, NaN or infinite entries take no part, nor, where lengths differ, those of another
    length than the most frequent (the longer of equally frequent ones). Null and repeated ids, and equal vectors, count row by
    row. Components without variance are left out, so a single vector, equal vectors and an empty table give no rows. Entries
    beyond 2**60 count as 2**60. Other columns are not read.
    """
    held, n, total = prepared(vectors, id, vector)
    fitted = fit(held, n, total, k)
    count, dim = len(fitted.values), len(total)
    error = identity_error(held, fitted) if count else 0.0
    share = fitted.values / fitted.trace if count else fitted.values
    component, size, deviation, out, explained = unused(vectors.select(id), "component", "n", "deviation", "whitened", "explained")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows if count else 0, CHUNK_ROWS):
                part = batch.slice(at, CHUNK_ROWS)
                x = matrix(part.column("x"), dim)
                rows = pa.array(np.repeat(np.arange(len(x)), count))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(rows),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(rows), n, np.int64)),
                        pa.array(deviations(x, n, total), pa.int64()).take(rows),
                        pa.array(fitted.project(x).ravel()),
                        pa.array(np.tile(share, len(x))),
                        pa.array(np.full(len(rows), error)),
                    ],
                    names=["id", component, size, deviation, out, explained, "identity_error"],
                )

    kind = held.schema["id"].dataType.simpleString()
    columns = f"id {kind}, {component} int, {size} long, {deviation} long, {out} double, {explained} double, identity_error double"
    return held.mapInArrow(run, columns).withColumnRenamed("id", id)
