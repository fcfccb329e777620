"""Logistic regressions by segment against Newton's method on each alone."""

import random

import numpy as np
from pyspark.sql import functions as F

from liftspark.operators import segments as S


def alone(rows, penalty):
    x = np.array([[1.0, *r[:-1]] for r in rows])
    y = np.array([r[-1] for r in rows])
    b = np.zeros(x.shape[1])
    ridge = np.diag([0.0] + [penalty] * (x.shape[1] - 1))
    for _ in range(100):
        p = 1 / (1 + np.exp(-x @ b))
        b = b + np.linalg.lstsq(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (y - p) - ridge @ b, rcond=None)[0]
    return b


def test_a_thousand_segments_and_a_heavy_one(spark, monkeypatch):
    r = random.Random(8)
    rows = []
    for s in range(1000):
        k = r.uniform(-1, 1)
        rows += [(s, "x", x := r.gauss(0, 1), z := r.random(), int(r.random() < 1 / (1 + np.exp(-k - x + z)))) for _ in range(30)]
    rows += [(None, None, x := r.gauss(0, 1), r.random(), int(r.random() < 1 / (1 + np.exp(1 - 2 * x)))) for _ in range(20_000)]
    rows += [(5, "x", None, 1.0, 1), (5, "x", 1.0, 1.0, None), (7, "y", float("nan"), 0.0, 1)]  # take no part
    df = spark.createDataFrame(rows, "seg int, side string, a double, b double, y int").repartition(6).persist()
    model = S.fit_logistic_by(df, ["seg", "side"], ["a", "b"], "y", penalty=0.5)
    got = {(m.seg, m.side): m for m in model.collect()}
    assert len(got) == 1001 and got[None, None].n == 20_000 and got[5, "x"].n == 30
    for key in [(None, None), *((s, "x") for s in range(0, 1000, 37))]:
        own = [x[2:] for x in rows if x[:2] == key and None not in x[2:]]
        assert np.allclose(got[key].weights, alone(own, 0.5), atol=1e-6), key
        assert got[key].responders == sum(x[-1] for x in own)
    monkeypatch.setattr(S, "BROADCAST_NUMBERS", 30)  # coefficients joined by a shuffle
    scored = S.score_by(df.filter("seg < 40 or seg is null").withColumn("weights", F.lit("mine")), model, ["seg", "side"], ["a", "b"])
    assert scored.columns == [*df.columns, "weights", "score"]
    for x in scored.filter("seg = 3").collect():
        w = got[3, "x"].weights
        assert abs(x.score - 1 / (1 + np.exp(-(w[0] + w[1] * x.a + w[2] * x.b)))) < 1e-12
    assert scored.filter("side = 'y'").count() == 1 and scored.filter("side = 'y' and score is not null").isEmpty()


def test_separated_and_single_class_segments(spark):
    rows = [(1, float(i), int(i > 4)) for i in range(10)] + [(2, float(i), 1) for i in range(5)] + [(3, 1.0, i % 2) for i in range(4)]
    df = spark.createDataFrame(rows, "seg int, a double, y int")
    got = {m.seg: m.weights for m in S.fit_logistic_by(df, ["seg"], ["a"], "y", penalty=0.01).collect()}
    assert got[1][1] > 0 and np.isfinite(got[1]).all() and got[2][0] > 10
    assert abs(got[3][0] + got[3][1]) < 1e-6  # a rate of a half
    assert S.fit_logistic_by(df.limit(0), ["seg"], ["a"], "y").count() == 0
