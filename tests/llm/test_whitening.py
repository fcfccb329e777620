"""Whitening against a full eigendecomposition and whole-number arithmetic."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from liftspark.llm import whitening as W
from liftspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(vectors, k=8):
    """n, deviations, eigenvalues, eigenvectors and whitened rows of plain lists."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    c = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in x])
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    return n, deviation, values, vectors, c @ vectors[:, :k] / np.sqrt(values[:k])


def check(rows, vectors, ids):
    n, deviation, values, _, white = brute(vectors)
    by = {(r.vec_id, r.component): r for r in rows}
    k = max(r.component for r in rows)
    assert len(by) == len(rows) == n * k
    for j in range(k):
        got = np.array([by[i, j + 1].whitened for i in ids])
        sign = np.sign(got @ white[:, j])
        gap = min(abs(values[j] - v) for i, v in enumerate(values) if i != j) / values[0]
        assert np.abs(got * sign - white[:, j]).max() < 1e-11 / max(gap, 1e-9) + 1e-9
        assert by[ids[0], j + 1].explained == pytest.approx(values[j] / values.sum(), rel=1e-9)
    assert [by[i, 1].deviation for i in ids] == deviation and {r.n for r in rows} == {n}
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-6
    return k


def test_query_against_brute_force(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    out = QUERIES["op11_whiten_embeddings"](spark, SF)
    assert out.dtypes == [
        ("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"),
        ("whitened", "double"), ("explained", "double"), ("identity_error", "double"),
    ]
    assert check(out.collect(), [r.embedding for r in table], [r.vec_id for r in table]) == 8


@pytest.mark.parametrize("values", [
    [9.0, 8, 7, 6, 5, 4, 3, 2] + [1] * 60,
    [5.0] * 3 + [4] * 30 + [3.999] * 40,  # wanted pairs inside a cluster wider than the block
    [1.0] * 70,
    list(np.geomspace(1, 1e-9, 80)),
    list(np.linspace(2, 1, 120)),
    [3.0, 2] + [0] * 50,
    [0.0] * 40,
    [2.0, 1],
])
def test_leading_pairs_of_known_operators(values):
    rng = np.random.default_rng(3)
    basis = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    matrix = (basis * values) @ basis.T
    got, vectors = W.leading(lambda q: matrix @ q, len(values), 8)
    want = sorted((v for v in values if v > W.RANK * max(values)), reverse=True)[:8]
    assert len(got) == len(want) and np.allclose(got, want, rtol=0, atol=1e-12 * max(values))
    if want:
        assert np.abs(vectors.T @ vectors - np.eye(len(want))).max() < 1e-13
        assert np.linalg.norm(matrix @ vectors - vectors * got, axis=0).max() <= 2e-12 * max(values)


def test_directions_that_the_start_lacks_are_found(monkeypatch):
    """A start without any part along the largest direction; only rounding or fresh directions bring it in."""
    values = np.append(100.0, np.linspace(2, 1, 99))

    class Blind:
        def __init__(self):
            self.inner, self.calls = np.random.Generator(np.random.PCG64(1)), 0

        def standard_normal(self, shape):
            out = self.inner.standard_normal(shape)
            self.calls += 1
            if self.calls == 1:
                out[0] = 0
            return out

    monkeypatch.setattr(W.np.random, "default_rng", lambda seed: Blind())
    got, _ = W.leading(lambda q: values[:, None] * q, 100, 8)
    assert np.allclose(got, values[:8], rtol=1e-10)


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    clash = ["id", "x", "dim", "component", "n", "whitened", "v", "deviation", "m", "task"]
    return df.select("*", *(F.lit("clash").alias(c) for c in clash)).repartition(3)


def test_awkward_rows(spark):
    rng = random.Random(2)
    good = [(i, [float(np.float32(rng.gauss(0, 1 + j))) for j in range(12)]) for i in range(60)]
    bad = [(100, None), (101, []), (102, [None] + [1.0] * 11), (103, [math.nan] * 12), (104, [math.inf] + [0.0] * 11), (105, [1.0] * 3), (106, [2.0] * 3)]
    good += [(200 + i, [0.5] * 12) for i in range(30)]  # equal vectors
    rows = W.whitened(frame(spark, good + bad)).collect()
    assert check(rows, [v for _, v in good], [i for i, _ in good]) == 8
    again = frame(spark, good + [(None, good[0][1]), (0, good[0][1])])
    rows = W.whitened(again).collect()  # null and repeated ids count row by row
    assert len(rows) == 8 * (len(good) + 2) and sum(r.vec_id is None for r in rows) == 8


def test_little_or_nothing(spark):
    assert W.whitened(frame(spark, [])).count() == 0
    assert W.whitened(frame(spark, [(1, None), (2, [math.nan])])).count() == 0
    assert W.whitened(frame(spark, [(1, [1.0, 2.0])])).count() == 0  # no variance
    assert W.whitened(frame(spark, [(i, [1.0, 2.0]) for i in range(5)])).count() == 0
    three = [(1, [1.0, 2.0, 3.0, 4.0]), (2, [0.0, 1.0, 5.0, 2.0]), (3, [7.0, 0.0, 0.0, 1.0])]
    assert check(W.whitened(frame(spark, three)).collect(), [v for _, v in three], [1, 2, 3]) == 2  # three points span a plane


def test_large_entries(spark):
    """Deviations beyond a long are null, others exact; entries beyond 2**60 count as that."""
    rows = [(i, [1e6 * i, -1e6 * i * i]) for i in range(40)]
    got = W.whitened(frame(spark, rows)).collect()
    _, deviation, _, _, _ = brute([v for _, v in rows])
    by = {r.vec_id: r.deviation for r in got}
    assert any(v is None for v in by.values()) and all(by[i] == (d if d < 1 << 63 else None) for i, d in enumerate(deviation))
    assert W.whitened(frame(spark, [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 0.0])])).count() > 0


def test_many_tasks_add_up_alike(spark, monkeypatch):
    monkeypatch.setattr(W, "PART_BYTES", (1 << 10, 1 << 11))
    monkeypatch.setattr(W, "ADDERS", 2)
    table = spark.read.parquet(f"{SF}/embeddings.parquet").limit(200)
    rows = table.collect()
    monkeypatch.setattr(W, "CHUNK_ROWS", 7)
    assert check(W.whitened(spark.createDataFrame(rows, table.schema)).collect(), [r.embedding for r in rows], [r.vec_id for r in rows]) == 8
