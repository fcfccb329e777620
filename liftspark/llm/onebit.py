"""Nearest neighbours by cosine over randomly rotated one-bit codes.

A unit vector is rotated at random and kept as the signs of its coordinates, plus one number: its inner product
with the unit vector of those signs. From bits and number the cosine with a query is estimated without bias, with
an error that is bounded with high probability. Every vector whose upper bound reaches the lower bound of the
best found so far is compared exactly; the others are out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from liftspark.llm.common import stored

#: Half width of the error bound in standard deviations of the estimate.
BOUND = 3.0
#: Indexed rows that a task compares with a block of queries, and queries of a block.
SHARD_ROWS, QUERY_ROWS = 8192, 256
#: Estimates per neighbour wanted that are compared exactly first; exact comparisons at once.
FIRST, PAIRS = 4, 1 << 14


@lru_cache(maxsize=4)
def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(11).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def units(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors scaled by their largest component, and the lengths they have then."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled, np.sqrt((scaled * scaled).sum(axis=1))


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits of the rotated vectors and the correction scalar of each."""
    scaled, length = units(vectors)
    turned = (scaled / length[:, None]) @ rotation(vectors.shape[1])
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])


def bounds(bits: np.ndarray, scalar: np.ndarray, queries: np.ndarray, width: float = BOUND) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the cosines of queries (rows) with indexed vectors (columns)."""
    dim = queries.shape[1]
    signs = np.unpackbits(bits, axis=1, count=dim).astype(np.float32) * 2 - 1
    scaled, length = units(queries)
    turned = ((scaled / length[:, None]) @ rotation(dim)).astype(np.float32)
    estimate = (turned @ signs.T) / (np.sqrt(dim) * scalar)
    error = width * np.sqrt(np.maximum(0, 1 - scalar**2) / (scalar**2 * max(1, dim - 1))) + 1e-5
    return estimate - error, estimate + error


def cosines(a: tuple[np.ndarray, np.ndarray], i: np.ndarray, b: tuple[np.ndarray, np.ndarray], j: np.ndarray) -> np.ndarray:
    """Of rows ``i`` of ``a`` with rows ``j`` of ``b``, both from ``units``; equal rows give equal results."""
    out = np.empty(len(i))
    for at in range(0, len(i), PAIRS):
        x, y = i[at : at + PAIRS], j[at : at + PAIRS]
        out[at : at + PAIRS] = (a[0][x] * b[0][y]).sum(axis=1) / (a[1][x] * b[1][y])
    return out


def nearest(ids: np.ndarray, vectors: np.ndarray, bits: np.ndarray, scalar: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """For each query the ``k`` nearest of these vectors that the bounds let through: (query, vec_id, score).

    The vectors of the best estimates are compared exactly first. The ``k``-th best of them is what the upper bound of any other must reach.
    """
    low, high = bounds(bits, scalar, queries)
    own = query_ids[:, None] == ids[None, :]
    low[own] = high[own] = -np.inf
    held, asked = units(vectors), units(queries)
    first = min(FIRST * k, len(ids))
    c = np.argpartition(low + high, len(ids) - first, axis=1)[:, len(ids) - first :].ravel()
    q = np.repeat(np.arange(len(queries)), first)
    exact = np.where(own[q, c], -np.inf, cosines(asked, q, held, c)).reshape(len(queries), first)
    least = np.sort(exact, axis=1)[:, max(0, first - k)]
    kept = high >= least[:, None]
    kept[q, c] = True  # known exactly already
    q, c = np.nonzero(kept & ~own)
    score = cosines(asked, q, held, c)
    order = np.lexsort((ids[c], -score, q))
    q, c, score = q[order], c[order], score[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    top = rank < k
    return query_ids[q[top]], ids[c[top]], score[top]


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dims = batch.column("dim").to_numpy(zero_copy_only=False)
        for dim in np.unique(dims):
            part = batch.filter(pa.array(dims == dim))
            vectors = part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, int(dim))
            bits, scalar = encode(vectors)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("vec_id"),
                    part.column("dim"),
                    pa.array([r.tobytes() for r in vectors], pa.binary()),
                    pa.array([r.tobytes() for r in bits], pa.binary()),
                    pa.array(scalar),
                ],
                names=["vec_id", "dim", "vector", "bits", "scalar"],
            )


def valid(vector: str) -> Column:
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~wrong & F.exists(vector, lambda x: x != 0)


def index(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, dim, vector, bits, scalar`` for every valid row (see ``neighbours``), stored in the shared folder."""
    rows = vectors.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & valid("vector")).withColumn("dim", F.size("vector"))
    return stored(rows.mapInArrow(_index, "vec_id long, dim int, vector binary, bits binary, scalar double"), "codes")


def neighbours(indexed: DataFrame, query_ids: Column, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest by cosine for each indexed row that ``query_ids`` selects.

    Candidates are all rows of the query's dimension but those of its own id; with fewer, all are returned. Ties go to
    the smaller id. Vectors that are null, empty, zero or hold null or non-finite components are not indexed, nor rows of a null id.
    Rows of one id are all candidates; of several as queries, the least vector counts. An empty table gives no rows.
    Queries meet the index in blocks: rows are dealt to shards, and each shard sees every query.
    """
    shards = max(1, -(-indexed.count() // SHARD_ROWS))
    shard = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards))
    held = indexed.select("dim", shard.alias("shard"), F.lit(0).alias("kind"), "vec_id", "vector", "bits", "scalar")
    asked = indexed.filter(query_ids).groupBy("vec_id", "dim").agg(F.min("vector").alias("vector"))
    asked = asked.select(
        "dim",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
        F.lit(1).alias("kind"),
        "vec_id",
        "vector",
        F.lit(None).cast("binary").alias("bits"),
        F.lit(None).cast("double").alias("scalar"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple[int, int] | None = None
        rows: list[tuple] = []
        queries: list[tuple] = []
        built: tuple | None = None

        def answer() -> Iterator[pa.RecordBatch]:
            nonlocal built
            if rows and queries:
                if built is None:
                    ids, vectors, bits, scalar = zip(*rows)
                    built = (
                        np.array(ids, np.int64),
                        np.frombuffer(b"".join(vectors)).reshape(len(ids), -1),
                        np.frombuffer(b"".join(bits), np.uint8).reshape(len(ids), -1),
                        np.array(scalar, np.float32),
                    )
                found = nearest(*built, np.array([q for q, _ in queries], np.int64), np.frombuffer(b"".join(v for _, v in queries)).reshape(len(queries), -1), k)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["query_id", "vec_id", "score"])
            queries.clear()

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("dim", "shard", "kind", "vec_id", "vector", "bits", "scalar")]
            for dim, at, kind, vec_id, vector, bits, scalar in zip(*columns):
                if (dim, at) != now:
                    yield from answer()
                    now, built = (dim, at), None
                    rows.clear()
                if kind:
                    queries.append((vec_id, vector))
                    if len(queries) == QUERY_ROWS:
                        yield from answer()
                else:
                    rows.append((vec_id, vector, bits, scalar))
        yield from answer()

    found = (
        held.unionByName(asked).repartition(shards, "dim", "shard").sortWithinPartitions("dim", "shard", "kind")
        .mapInArrow(run, "query_id long, vec_id long, score double")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
