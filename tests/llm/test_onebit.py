import numpy as np
import pytest
from pyspark.sql import functions as F

from liftspark.llm import onebit
from liftspark.llm.onebit import bounds, encode, index, neighbours


def brute(rows, k, is_query):
    def ok(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)

    rows = [(i, np.array(v, float)) for i, v in rows if i is not None and ok(v)]
    out = []
    for q, a in rows:
        if is_query(q):
            found = sorted((-float(a @ b / np.sqrt((a @ a) * (b @ b))), i) for i, b in rows if i != q and len(b) == len(a))
            found = sorted((round(s, 10), i) for s, i in found)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows", [8192, 40])
def test_against_brute_force(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(onebit, "SHARD_ROWS", shard_rows)
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((400, 32)).astype(np.float32)
    vectors[50:120] = vectors[50]  # a very common vector
    vectors[130] = -vectors[50]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(900, None), (950, []), (1000, [0.0] * 32), (1050, [1.0, None] + [0.0] * 30), (1100, [float("nan")] * 32), (None, [1.0] * 32)]
    rows += [(1150, [1.0, 2.0]), (1151, [2.0, 1.0]), (1152, [-1.0, 0.0]), (1200, [3.0] * 5), (1250, [float("inf")] + [0.0] * 31)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash")).withColumn("bits", F.lit(1)).repartition(3)
    got = sorted(tuple(r) for r in neighbours(index(df), F.col("vec_id") % 50 == 0).collect())
    want = brute(rows, 5, lambda i: i % 50 == 0)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want])


def test_very_large_and_small_components(spark):
    rows = [(0, [1e300, 1e300]), (1, [1e-300, 1.1e-300]), (2, [1.0, -1.0])]
    got = neighbours(index(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), F.col("vec_id") == 0).collect()
    assert [r.vec_id for r in got] == [1, 2] and got[0].score == pytest.approx(2.1 / np.sqrt(2 * 2.21))


def test_repeated_ids_and_empty(spark):
    rows = [(0, [1.0, 0.0])] * 3 + [(5, [1.0, 1.0])] * 2
    got = neighbours(index(spark.createDataFrame(rows, "vec_id long, embedding array<float>")), F.col("vec_id") == 0).collect()
    assert [(r.rank, r.vec_id) for r in got] == [(1, 5), (2, 5)]
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours(index(none), F.col("vec_id") % 50 == 0).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(2)
    v, q = rng.standard_normal((2000, 64)), rng.standard_normal((50, 64))
    low, high = bounds(*encode(v), q)
    true = (q / np.linalg.norm(q, axis=1)[:, None]) @ (v / np.linalg.norm(v, axis=1)[:, None]).T
    assert ((low <= true) & (true <= high)).mean() > 0.995
