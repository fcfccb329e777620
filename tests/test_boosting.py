"""Leaf-wise boosted trees against plain loops over rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from liftspark.operators import boosting as B


def plain_tree(rows, g, h, s):
    """Grow best first over rows by trying every cut of every feature; returns a function from a row to a value."""

    def worth(a, b):
        return max(abs(a) - s.l1, 0) ** 2 / (b + s.l2 + 1e-300)

    def best(at, depth):
        if s.depth and depth >= s.depth:
            return None
        found = None
        total = worth(sum(g[i] for i in at), sum(h[i] for i in at))
        for f in range(len(rows[0])):
            for cut in range(max(r[f] for r in rows)):
                low, high = [i for i in at if rows[i][f] <= cut], [i for i in at if rows[i][f] > cut]
                if min(len(low), len(high)) < max(s.min_rows, 1) or min(sum(h[i] for i in low), sum(h[i] for i in high)) < s.min_hessian:
                    continue
                gain = sum(worth(sum(g[i] for i in side), sum(h[i] for i in side)) for side in (low, high)) - total
                if gain > 1e-12 * (1 + total) and (found is None or gain > found[0] + 1e-9):
                    found = (gain, f, cut, low, high)
        return found

    leaves = [(list(range(len(rows))), 0)]
    while len(leaves) < s.leaves:
        options = [(best(at, d), k) for k, (at, d) in enumerate(leaves)]
        options = [(o, k) for o, k in options if o]
        if not options:
            break
        (_, _, _, low, high), k = max(options, key=lambda o: o[0][0])
        depth = leaves[k][1] + 1
        leaves[k : k + 1] = [(low, depth), (high, depth)]
    out = [0.0] * len(rows)
    for at, _ in leaves:
        a, b = sum(g[i] for i in at), sum(h[i] for i in at)
        for i in at:
            out[i] = -math.copysign(max(abs(a) - s.l1, 0), a) / (b + s.l2 + 1e-300) * s.step
    return out


def plain_scores(rows, y, objective, s, classes=1):
    n = len(rows)
    share = [sum(1 for v in y if v == k) / n for k in range(classes)] if objective == "softmax" else [sum(y) / n]
    base = share if objective == "squared" else [math.log(p) for p in share] if objective == "softmax" else [math.log(share[0] / (1 - share[0]))]
    scores = [list(base) for _ in rows]
    for _ in range(s.rounds):
        if objective == "squared":
            p = scores
        elif objective == "logistic":
            p = [[1 / (1 + math.exp(-v[0]))] for v in scores]
        else:
            p = [[math.exp(v) / sum(math.exp(u) for u in row) for v in row] for row in scores]
        p = [list(r) for r in p]
        for k in range(len(base)):
            g = [p[i][k] - (y[i] if objective != "softmax" else float(y[i] == k)) for i in range(n)]
            h = [1.0 if objective == "squared" else p[i][k] * (1 - p[i][k]) for i in range(n)]
            for i, v in enumerate(plain_tree(rows, g, h, s)):
                scores[i][k] += v
    return scores


def sample(n, seed, classes=0):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = r.randint(0, 6), r.choice([None, 0.5, 1.5, 9.25]), r.randint(0, 3)
        y = a * 3 + (b or 4) * 2 + (5 if c == 2 and a > 3 else 0) + r.randint(-2, 2)
        rows.append((i, a, b, c, float(int(y) % classes if classes > 2 else y > 18 if classes else y)))
    return rows


def bins_of(rows):
    b = {None: 0, 0.5: 1, 1.5: 2, 9.25: 3}
    return [(a + 1, b[v], c + 1) for _, a, v, c, _ in rows]


SETTINGS = [
    B.Settings(rounds=3, leaves=6, min_rows=3, step=0.5),
    B.Settings(rounds=2, leaves=12, depth=2, min_rows=1, l1=0.7, l2=2.0),
    B.Settings(rounds=2, leaves=40, min_rows=8, min_hessian=2.0, step=1.0),
    B.Settings(rounds=2, leaves=1),
]


@pytest.mark.parametrize(("objective", "which"), [("squared", 0), ("squared", 1), ("squared", 3), ("logistic", 0), ("logistic", 2), ("softmax", 1), ("softmax", 2)])
def test_trees_against_loops(spark, monkeypatch, objective, which):
    """Both ways of training: on one block, and on blocks of a few cells in passes."""
    settings = SETTINGS[which]
    classes = {"squared": 0, "logistic": 2, "softmax": 3}[objective]
    rows = sample(90, len(objective), classes)
    want = plain_scores(bins_of(rows), [r[4] for r in rows], objective, settings, max(classes, 1))
    df = spark.createDataFrame(rows, "id int, a int, b double, c int, y double").repartition(3)
    for size in (B.BLOCK_CELLS, 20):
        monkeypatch.setattr(B, "BLOCK_CELLS", size)
        monkeypatch.setattr(B, "REFRESH", 2)
        model = B.fit_boosted(df, ["a", "b", "c"], "y", objective, settings, classes if objective == "softmax" else 0)
        got = {r.id: r.scores for r in model.with_scores(df).collect()}
        assert np.allclose([got[r[0]] for r in rows], want, atol=1e-9), size


def test_transform(spark):
    rows = sample(60, 5, 3)
    df = spark.createDataFrame(rows, "id int, a int, b double, c int, y double").withColumn("other", F.lit("x"))
    model = B.fit_boosted(df, ["a", "b", "c"], "y", "softmax", B.Settings(rounds=5, min_rows=2), 3)
    out = model.transform(df)
    assert out.columns == [*df.columns, "prediction", "probability"]
    for r in out.collect():
        assert abs(sum(r.probability) - 1) < 1e-12 and r.prediction == int(np.argmax(r.probability))
    binary = B.fit_boosted(df.withColumn("y", (F.col("y") > 0).cast("int")), ["a", "c"], "y", settings=B.Settings(rounds=5, min_rows=2))
    assert all(len(r.probability) == 2 and (r.prediction == 1) == (r.probability[1] > 0.5) for r in binary.transform(df).collect())
    assert model.transform(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        B.fit_boosted(df.limit(0), ["a"], "y")
    with pytest.raises(ValueError):
        B.fit_boosted(df, ["a"], "y", "softmax")


def test_bins(spark):
    rows = [(float(i % 7) if i % 5 else None, float(i), math.nan if i % 3 else 2.0) for i in range(3000)]
    df = spark.createDataFrame(rows, "few double, many double, odd double")
    few, many, odd = B.bin_edges(df, ["few", "many", "odd"], 50)
    assert few.tolist() == [0.5, 1.5, 2.5, 3.5, 4.5, 5.5] and 30 < len(many) <= 48 and len(odd) == 0
    sizes = np.bincount(B.binned([np.arange(3000.0)], [many])[:, 0])
    assert sizes[0] == 0 and sizes[1:].max() < 200
    assert B.binned([np.array([math.nan, -1, 0.5, 0.6, 99])], [few])[:, 0].tolist() == [0, 1, 1, 2, 7]


@pytest.mark.parametrize("size", [B.BLOCK_CELLS, 25])
def test_cross_validation_against_loops(spark, monkeypatch, size):
    monkeypatch.setattr(B, "BLOCK_CELLS", size)
    rows = sample(80, 11)
    df = spark.createDataFrame(rows, "id int, a int, b double, c int, y double")
    points = [B.Settings(rounds=2, leaves=4, min_rows=2), B.Settings(rounds=3, leaves=3, l2=1.0, step=0.3, min_rows=5)]
    got = {(r.trial, r.fold): r.loss for r in B.cross_validate(df, ["a", "b", "c"], "y", "id", points, folds=3).collect()}
    fold = {r.id: r.f for r in df.selectExpr("id", "pmod(hash(concat('fold-0:', id)), 3) f").collect()}
    for t, s in enumerate(points):
        for k in range(3):
            train = [r for r in rows if fold[r[0]] != k]
            model = B.fit_boosted(spark.createDataFrame(train, df.schema), ["a", "b", "c"], "y", "squared", s)
            held = spark.createDataFrame([r for r in rows if fold[r[0]] == k], df.schema)
            error = model.transform(held).selectExpr("avg((prediction - y) * (prediction - y))").first()[0]
            assert got[t, k] == pytest.approx(error, rel=1e-9), (t, k)


def test_halving(spark):
    assert list(B.Halving(11, 3).rungs(180, 100)) == [(180, 11), (60, 33), (20, 99), (7, 100)]
    assert list(B.Halving(4, 2).rungs(5, 4)) == [(5, 4)]
    df = spark.createDataFrame(sample(120, 3), "id int, a int, b double, c int, y double")
    points = [B.Settings(rounds=8, step=s, min_rows=3, leaves=4) for s in (0.001, 0.5, 0.002, 0.3)]
    rows = B.cross_validate(df, ["a", "b", "c"], "y", "id", points, folds=2, halving=B.Halving(2, 2)).collect()
    reached = {t: max(r.rounds for r in rows if r.trial == t) for t in range(4)}
    assert reached == {0: 2, 1: 8, 2: 2, 3: 4} or reached == {0: 2, 1: 4, 2: 2, 3: 8}
    full = {(r.trial, r.fold): r.loss for r in B.cross_validate(df, ["a", "b", "c"], "y", "id", points, folds=2).collect()}
    for r in rows:
        if r.rounds == 8:
            assert r.loss == pytest.approx(full[r.trial, r.fold])


def test_one_model_on_many_cells_takes_no_passes(spark, monkeypatch):
    """Passes cost a job each: a table that a task can hold is trained on at once, though it has many blocks of cells."""
    monkeypatch.setattr(B, "_train_spread", lambda *_: pytest.fail("passes"))
    df = spark.range(80_000).selectExpr("id % 251 AS a", "id % 241 AS b", "id % 239 AS c", "id % 251 + 0.5 * (id % 241) AS y")
    model = B.fit_boosted(df, ["a", "b", "c"], "y", "squared", B.Settings(rounds=2, leaves=4, step=1.0))
    assert model.split_shares()[2] == 0 and [len(t.feature) for row in model.rounds for t in row] == [7, 7]
