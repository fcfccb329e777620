"""Ridge grids, adaptive search on the run log, and attempts in it."""

import itertools
import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from liftspark.operators import models as M
from liftspark.operators import ridge as RI
from liftspark.operators import runlog as R
from liftspark.operators import tuning as T


def test_ridge_against_least_squares(spark):
    r = random.Random(4)
    rows = [(i, 1e6 + r.random(), r.gauss(0, 3), r.random()) for i in range(200)]
    rows = [(i, a, b, c, 2 * (a - 1e6) - b + r.gauss(0, 0.1)) for i, a, b, c in rows]
    rows += [(900, None, 1.0, 1.0, 1.0), (901, 1.0, math.nan, 1.0, 1.0)]  # take no part
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, y double").repartition(5)
    points = [RI.RidgePoint(p, f) for p in (0.0, 0.5, 100.0) for f in (("a",), ("c", "b"), ("a", "b", "c"))]
    got = {(x.trial, x.fold): x.loss for x in RI.cross_validate(df, "y", "id", points, 3).collect()}
    fold = {x.id: x.f for x in df.selectExpr("id", "pmod(hash(concat('fold-0:', id)), 3) f").collect()}
    for (t, p), k in itertools.product(enumerate(points), range(3)):
        at = ["abc".index(c) + 1 for c in p.features]
        side = lambda mine: np.array([[x[j] for j in (*at, 4)] for x in rows[:200] if (fold[x[0]] == k) == mine])  # noqa: B023, E731
        train, held = side(False), side(True)
        mean = train.mean(axis=0)
        x, y = (train - mean)[:, :-1], (train - mean)[:, -1]
        slopes = np.linalg.solve(x.T @ x + p.penalty * np.eye(len(at)), x.T @ y)
        error = ((held[:, -1] - mean[-1] - (held[:, :-1] - mean[:-1]) @ slopes) ** 2).mean()
        assert got[t, k] == pytest.approx(error, rel=1e-6), (t, k)


CHOICES = {"a": [1, 2, 3, 4], "b": ["x", "y", "z"], "c": [0.1, 0.2]}


def slow_ratio(history, point, share=0.25, prior=1.0):
    ranked = sorted(history, key=lambda h: h[1])
    good = ranked[: math.ceil(share * len(ranked))]
    out = 1.0
    for name, values in CHOICES.items():
        p = (sum(h[0][name] == point[name] for h in good) + prior) / (len(good) + prior * len(values))
        q = (sum(h[0][name] == point[name] for h in ranked[len(good) :]) + prior) / (len(ranked) - len(good) + prior * len(values))
        out *= p / q
    return out


def test_suggestions_have_the_largest_ratio():
    r = random.Random(1)
    grid = T.all_points(CHOICES)
    assert len(grid) == 24 and grid[1] == {"a": 1, "b": "x", "c": 0.2}
    for n in (3, 8, 15, 23):
        history = [(p, r.random()) for p in r.sample(grid, n)]
        tried = [p for p, _ in history]
        got = T.suggest(history, CHOICES, startup=0)
        assert got not in tried
        best = max(slow_ratio(history, p) for p in grid if p not in tried)
        assert slow_ratio(history, got) == pytest.approx(best)
        assert got == T.suggest(history, CHOICES, startup=0)
    assert T.suggest([(p, 0.0) for p in grid], CHOICES) is None
    first = T.suggest([], CHOICES)
    assert first in grid and first == T.suggest([], CHOICES)


def objective(point):
    return [-((point["a"] - 3) ** 2) - (point["b"] != "y") - point["c"]] * 2


def test_a_search_goes_on_from_its_log(spark, tmp_path):
    whole, best = T.adaptive_search(spark, CHOICES, objective, str(tmp_path / "one"), "s", 9, startup=4)
    path = str(tmp_path / "two")
    T.adaptive_search(spark, CHOICES, objective, path, "other", 2)
    calls = []
    for budget in (3, 9):
        again, same = T.adaptive_search(spark, CHOICES, lambda p: calls.append(p) or objective(p), path, "s", budget, startup=4)
    assert again == whole and same == best and calls == [p for p, _ in whole]
    assert best == max(whole, key=lambda t: t[1])[0]


def test_better_than_random():
    """On a fixed table of results the mean of the best of 12 in 60 points beats a random draw's."""
    choices = {k: list(range(n)) for k, n in (("p", 5), ("q", 4), ("r", 3))}
    loss = lambda x: (x["p"] - 3) ** 2 + 2 * (x["q"] != 1) + (x["r"] - 2) ** 2
    found, drawn = [], []
    for seed in range(40):
        history = []
        while len(history) < 12:
            p = T.suggest(history, choices, seed=seed, startup=4)
            history.append((p, loss(p)))
        found.append(min(v for _, v in history))
        drawn.append(min(map(loss, random.Random(seed).sample(T.all_points(choices), 12))))
    assert np.mean(found) < np.mean(drawn) - 0.2, (np.mean(found), np.mean(drawn))


def test_grid_search_logs_its_folds(spark, tmp_path):
    r = random.Random(6)
    rows = [(i, r.random(), int(r.random() < 0.5)) for i in range(300)]
    df = spark.createDataFrame(rows, "jobid bigint, a double, final_response int")
    from pyspark.ml.feature import VectorAssembler

    df = VectorAssembler(inputCols=["a"], outputCol="f").transform(df)
    estimator, _ = M.classifier("LR", "f")
    grid = M.param_grid(estimator, {"regParam": [0.001, 0.9]})
    path = str(tmp_path / "log")
    table, _ = T.grid_search(df, estimator, grid, M.evaluator(), "jobid", folds=2, log_path=path, search="lr")
    trials = T.logged_trials(spark, path, "lr", ["regParam"])
    assert [(t, p) for t, p, _ in trials] == [(0, {"regParam": 0.001}), (1, {"regParam": 0.9})]
    assert [s for _, _, s in trials] == pytest.approx([x.score for x in table.orderBy("trial").collect()])
    one = T.fold_objective(df, estimator, M.evaluator(), "jobid")({"regParam": 0.9})
    _, kv = R.read_log(spark, path)
    assert one == [x.value for x in kv.filter("key = 'score' and run_id = 'lr-00001'").orderBy("step").collect()]


def test_half_written_attempts_are_not_read(spark, tmp_path):
    path = str(tmp_path / "log")
    assert not R.exists(spark, path)
    R.log_runs(spark, path, [{"run_id": "a", "metrics": {"m": [1.0, 2.0]}, "params": {"p": 1}}])
    assert R.exists(spark, path)
    torn = spark.createDataFrame([("a", "m", 0, 9.0, None, "metric"), ("b", "m", 0, 7.0, None, "metric")], R.KV_SCHEMA)
    torn.withColumns({"attempt": F.lit("torn"), "logged_at": F.lit(1 << 62)}).write.mode("append").partitionBy("kind").parquet(f"{path}/run_kv")
    rows = {(r.run_id, r.key, r.step): (r.value, r.text) for r in R.read_log(spark, path)[1].collect()}
    assert rows == {("a", "m", 0): (1.0, None), ("a", "m", 1): (2.0, None), ("a", "p", 0): (None, "1")}
    R.log_runs(spark, path, [{"run_id": "a", "metrics": {"m": [5.0]}}])  # logged anew: the last value of a step counts
    runs, kv = R.read_log(spark, path)
    assert runs.count() == 1 and {(r.step, r.value) for r in kv.filter("key = 'm'").collect()} == {(0, 5.0), (1, 2.0)}
    assert json.loads(kv.filter("key = 'p'").first()["text"]) == 1
