import math
import random

import pytest

from liftspark.operators import curves, metrics
from tests import model

SCHEMA = "id bigint, score double, y int"


def sample(n=250, distinct=20, seed=5):
    r = random.Random(seed)
    return [(i, r.randrange(distinct) / distinct, int(r.random() < 0.4)) for i in range(n)]


@pytest.mark.parametrize("distinct", [1, 7, 100_000])
def test_auc(spark, small_cells, distinct):
    rows = sample(distinct=distinct)
    df = spark.createDataFrame(rows, SCHEMA)
    area = curves.auc(df, "score", "y").first()["auc"]
    assert area == pytest.approx(model.auc(rows), abs=1e-12)
    flipped = curves.auc(df.selectExpr("id", "-score AS score", "y"), "score", "y").first()["auc"]
    assert area + flipped == pytest.approx(1)


def test_curves(spark, small_cells):
    rows = sample()
    df = spark.createDataFrame(rows, SCHEMA)
    pos = sum(r[2] for r in rows)
    neg = len(rows) - pos
    points = model.thresholds(rows)
    roc = {(r["threshold"], r["fpr"], r["tpr"]) for r in curves.roc_curve(df, "score", "y", drop_intermediate=False).collect()}
    every = [(t, fp / neg, tp / pos) for t, tp, fp, _ in points]
    assert roc == {(None, 0.0, 0.0), *every}
    at = [(0, 0), *((p[2], p[1]) for p in points)]
    steps = [(b[0] - a[0], b[1] - a[1]) for a, b in zip(at, at[1:])]
    kept = [p for i, p in enumerate(every) if i in (0, len(every) - 1) or steps[i] != steps[i + 1]]
    corners = {(r["threshold"], r["fpr"], r["tpr"]) for r in curves.roc_curve(df, "score", "y").collect()}
    assert corners == {(None, 0.0, 0.0), *kept} and len(kept) < len(every)
    pr = {(r["threshold"], r["precision"], r["recall"]) for r in curves.precision_recall_curve(df, "score", "y").collect()}
    assert pr == {(None, 1.0, 0.0)} | {(t, tp / (tp + fp), tp / pos) for t, tp, fp, _ in points}


@pytest.mark.parametrize("seed,distinct", [(5, 20), (6, 300), (7, 3)])
def test_det_curve(spark, small_cells, seed, distinct):
    rows = sample(distinct=distinct, seed=seed)
    pos = sum(r[2] for r in rows)
    neg = len(rows) - pos
    points = model.thresholds(rows)
    first_fp = points[0][2]
    begin = max(i for i, p in enumerate(points) if p[2] == first_fp)
    end = min(i for i, p in enumerate(points) if p[1] == pos)
    want = {(t, fp / neg, (pos - tp) / pos) for t, tp, fp, _ in points[begin : end + 1]}
    df = spark.createDataFrame(rows, SCHEMA)
    assert {(r["threshold"], r["fpr"], r["fnr"]) for r in curves.det_curve(df, "score", "y").collect()} == want


def test_curves_by_key(spark, small_cells):
    rows = [(*r, "a" if r[0] % 3 else None) for r in sample()]
    df = spark.createDataFrame(rows, SCHEMA + ", k string")
    for k in ("a", None):
        mine = [r[:3] for r in rows if r[3] == k]
        got = [r for r in curves.auc(df, "score", "y", ["k"]).collect() if r["k"] == k]
        assert got[0]["auc"] == pytest.approx(model.auc(mine))
        tops = {r["threshold"] for r in curves.roc_curve(df, "score", "y", ["k"], drop_intermediate=False).collect() if r["k"] == k}
        assert tops == {None} | {r[1] for r in mine}
        assert [r for r in curves.det_curve(df, "score", "y", ["k"]).collect() if r["k"] == k]


def test_mean_average_precision(spark, small_cells):
    r = random.Random(2)
    rows = [(q, i, r.random(), int(r.random() < 0.3)) for q in range(8) for i in range(6)]
    rows += [(99, i, r.random(), 0) for i in range(4)]
    total = 0.0
    for q in {x[0] for x in rows}:
        order = sorted((x for x in rows if x[0] == q), key=lambda x: (-x[2], x[1]))
        hits, ap = 0, 0.0
        for i, x in enumerate(order):
            hits += x[3]
            ap += x[3] * hits / (i + 1)
        total += ap / hits if hits else 0
    df = spark.createDataFrame(rows, "q bigint, item bigint, s double, rel int")
    got = curves.mean_average_precision(df, "q", "item", "s", "rel").first()
    assert got["mean_avg_precision"] == pytest.approx(total / 9) and got["n_queries"] == 9


def test_no_positive_label(spark):
    df = spark.createDataFrame([(1, 0.5, 0)], SCHEMA)
    with pytest.raises(ValueError, match="no positive label"):
        curves.auc(df, "score", "y")


def test_binary_metrics(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (0, 0)], "y int, p int")
    got = metrics.binary_metrics(df, "y", "p").first()
    assert (got["precision"], got["recall"], got["accuracy"], got["f1"]) == (0.5, 0.5, 0.6, 0.5)
    none = metrics.binary_metrics(spark.createDataFrame([(0, 0)], "y int, p int"), "y", "p").first()
    assert (none["precision"], none["recall"], none["accuracy"], none["f1"]) == (0.0, 0.0, 1.0, 0.0)


def test_multiclass_and_confusion(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "c"), ("c", "c"), ("a", "b")], "y string, p string")
    assert set(metrics.multiclass_metrics(df, "y", "p").first()) == {0.5}
    assert {tuple(r) for r in metrics.confusion_matrix(df, "y", "p").collect()} == {
        ("a", "a", 1), ("b", "c", 1), ("c", "c", 1), ("a", "b", 1),
    }


def test_log_loss_is_clipped(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 0.0), (1, 1.0), (1, 0.5)], "y int, p double")
    want = (-math.log(1e-15) - 2 * math.log(1 - 1e-15) + math.log(2)) / 4
    assert metrics.log_loss(df, "y", "p").first()["log_loss"] == pytest.approx(want)


def test_regression_metrics(spark):
    rows = [(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)]
    mean = 7 / 3
    got = metrics.regression_metrics(spark.createDataFrame(rows, "y double, p double"), "y", "p").first()
    sse = sum((y - p) ** 2 for y, p in rows)
    assert got["mse"] == pytest.approx(sse / 3)
    assert got["r2"] == pytest.approx(1 - sse / sum((y - mean) ** 2 for y, _ in rows))
    flat = [(spark.createDataFrame([(2.0, p)] * 3, "y double, p double"), want) for p, want in ((2.0, 1.0), (3.0, 0.0))]
    assert all(metrics.regression_metrics(df, "y", "p").first()["r2"] == want for df, want in flat)
