import datetime as dt
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RankingEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from liftspark.functions.columns import last_probability
from liftspark.operators import models as M
from liftspark.operators import overfit as O
from liftspark.operators import runlog as R
from liftspark.operators import tuning as T
from liftspark.operators.features import TrainingSet
from liftspark.operators.gain import GainEvaluator
from tests import model as plain


@pytest.fixture(scope="module")
def data(spark):
    r = random.Random(11)
    rows = []
    for i in range(600):
        a, b = r.random(), r.random()
        rows.append((i, a, b, "u" if b > 0.5 else "v", int(a + 0.3 * b + 0.2 * r.random() > 0.8)))
    df = spark.createDataFrame(rows, "jobid bigint, a double, b double, c string, final_response int")
    return VectorAssembler(inputCols=["a", "b"], outputCol="f").transform(df).persist()


@pytest.mark.parametrize("method", M.METHODS)
def test_methods(data, method):
    estimator, grid = M.classifier(method, "f")
    assert len(grid) == 1
    model = estimator.copy({p: v for p, v in grid[0].items() if p.name != "numTrees"}).fit(data)
    predicted = model.transform(data)
    scored = predicted.select("jobid", last_probability(predicted, "predict_prob").alias("s"), "final_response")
    want = plain.gains([tuple(r) for r in scored.collect()])[7][9]
    assert M.evaluator().evaluate(predicted) == want > 0.3
    assert M.params_of(grid, model).keys() == M.SETTINGS[method].keys()


def test_grid_sizes():
    sizes = {m: len(M.classifier(m, "f", grid=True)[1]) for m in M.METHODS}
    assert sizes == {"RF": 27, "SVM": 9, "LR": 32, "GBT": 1}
    _, grid = M.classifier("LR", "f", grid=True)
    assert M.grid_choices(grid) == M.CHOICES["LR"]


def test_evaluator_factory(spark):
    assert isinstance(M.evaluator("CG2D"), GainEvaluator)
    assert isinstance(M.evaluator("mAP"), RankingEvaluator)
    assert isinstance(M.evaluator("AUC"), BinaryClassificationEvaluator)
    judge = M.evaluator("mAP", "y", "id", query="q")
    rows = [(1, "a", 0.9, 1), (2, "a", 0.8, 0), (3, "a", 0.7, 1), (4, "b", 0.1, 0), (5, "b", 0.1, 1), (6, "c", 0.5, 0)]
    scored = spark.createDataFrame(rows, "id int, q string, predict_prob double, y int")
    assert judge.isLargerBetter() and judge.evaluate(scored) == pytest.approx(((1 + 2 / 3) / 2 + 1 / 2 + 0) / 3)
    assert M.evaluator("AUC").getRawPredictionCol() == "predict_int"


def test_expert_settings():
    expert = M.expert_classifier("f")
    assert (expert.getMaxIter(), expert.getStepSize(), expert.getMaxDepth()) == (650, 0.01, 8)
    assert M.expert_classifier("f", maxIter=3).getMaxIter() == 3


def test_search(data):
    estimator, _ = M.classifier("LR", "f")
    grid = M.param_grid(estimator, {"regParam": [0.001, 0.9], "maxIter": [5]})
    table, best = T.grid_search(data, estimator, grid, M.evaluator(), "jobid", folds=2, parallelism=2)
    rows = sorted(tuple(r) for r in table.collect())
    # the same search, step by step
    for trial, point in enumerate(grid):
        scores = []
        for fold in range(2):
            mine = F.expr(f"pmod(hash(concat('fold-0:', jobid)), 2) = {fold}")
            model = estimator.fit(data.filter(~mine), point)
            scores.append(M.evaluator().evaluate(model.transform(data.filter(mine))))
        assert rows[trial][2] == pytest.approx(sum(scores) / 2)
        assert rows[trial][3] == pytest.approx(abs(scores[0] - scores[1]) / 2)
    assert best is grid[T.best_index([r[2] for r in rows])]
    again, _ = T.random_search(data, estimator, grid, M.evaluator(), "jobid", max_evals=9, folds=2)
    assert {r["params"] for r in again.collect()} == {r[1] for r in rows}
    scores, model = T.validation_split(data, estimator, grid, M.evaluator(), "jobid", 0.8)
    assert scores.count() == 2 and model.transform(data).count() == 600


def test_limits_of_iterations_share_a_fit(data, monkeypatch):
    """A fit that stops by itself stands for all maps with a larger limit; what the others get is what they'd get alone."""
    estimator, _ = M.classifier("LR", "f")
    grid = M.param_grid(estimator, {"maxIter": [1, 30, 60], "regParam": [0.01, 0.9]})
    alone = [M.evaluator().evaluate(estimator.fit(data, point).transform(data)) for point in grid]
    fits, plain = [], type(estimator).fit
    monkeypatch.setattr(type(estimator), "fit", lambda self, df, point=None: fits.append(point) or plain(self, df, point))
    (scores,) = T._scores([(data, data)], estimator, grid, M.evaluator(), 2)
    assert scores == alone
    limits = sorted(p[estimator.maxIter] for p in fits)
    assert limits in ([1, 1, 60, 60], [1, 60, 60], [60, 60])
    assert T.by_limit(estimator, [{}, {}]) == [[0], [1]] and T.by_limit(estimator, grid) == [[4, 2, 0], [5, 3, 1]]


def test_best_index():
    assert T.best_index([0.1, 0.3, 0.3]) == 1
    assert T.best_index([0.0, 0.0]) == 0
    assert T.best_index([3.0, 1.0, 2.0], larger_is_better=False) == 1
    assert T.best_index([float("nan"), 0.2]) == 1


@pytest.mark.parametrize("task", ["classification", "propensity", "multiclassClassification", "regression"])
def test_auto(data, task):
    target = "b" if task == "regression" else "final_response"
    config = TrainingSet("jobid", target, task, drop=("f",))
    model = M.train_auto(data, config, rounds=3)
    predicted = model.predict(data)
    assert predicted.count() == 600
    got = M.evaluate_auto(predicted, config).first().asDict()
    assert all(v == v for v in got.values())
    names = [r["feature"] for r in model.importance(data).collect()]
    assert set(names) == set(model.features.columns)


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "log")
    start = dt.datetime(2022, 3, 4, 5, 6)
    R.log_runs(spark, path, [
        {"run_id": "abcdefghij", "start_time": start, "params": {"mlModelClass": "GBTClassifier", "lr": 0.1}, "metrics": {"CG2D": [0.1, 0.4]}, "tags": {"t": "grid"}},
        {"run_id": "second", "run_name": "named", "status": "FAILED", "metrics": {"CG2D": 0.9}},
    ])
    R.log_runs(spark, path, [{"run_id": "third", "run_name": "n3", "metrics": {"avg_CG2D": 0.3}}])
    runs, kv = R.read_log(spark, path)
    wide = R.runs_wide(kv, ["CG2D", "avg_CG2D"], ["mlModelClass", "lr"], ["t"])
    joined = runs.join(wide, "run_id").withColumn("m", R.metric_or("metric_CG2D", "metric_avg_CG2D"))
    got = {r["run_id"]: r for r in joined.collect()}
    assert got["abcdefghij"]["m"] == 0.4 and got["abcdefghij"]["param_lr"] == "0.1" and got["third"]["m"] == 0.3
    names = {r[0] for r in joined.select(R.display_name("run_name", "param_mlModelClass", "start_time", "run_id")).collect()}
    assert "GBT-0304-0506\nid: abcdefgh" in names and "named\nid: second" in names
    assert [r["run_id"] for r in R.leaderboard(joined, "m").collect()] == ["third", "abcdefghij"]
    assert R.best_run(joined, "m").first()["run_id"] == "second"
    assert R.best_run(joined, "m", "status <> 'FAILED'", ascending=True).first()["run_id"] == "third"


def test_overfit(spark):
    rows = [
        (g, t, s, "sales", "mob", 100, n, v)
        for g in (0.1, 0.2)
        for t, k in (("a", 1.0), ("b_c", 0.5), ("national", 0.8))
        for s, n, v in (("train", 10, 0.5), ("test1", 9, 0.5 * k), ("test2", 8, 0.4))
    ]
    lift = spark.createDataFrame(rows, "group double, tag string, test_type string, capture_type string, prod_type string, size_cum bigint, resp_num_cum bigint, gain_cum double")
    delta = {(r["group"], r["tag"]): r["train_test1"] for r in O.overfit_delta(lift).collect()}
    assert delta[(0.2, "b_c")] == pytest.approx(-0.5) and delta[(0.1, "a")] == 0
    flags = O.overfit_flags(O.overfit_delta(lift), 0.2)
    assert [r["tag"] for r in flags.collect()] == ["a"]
    assert len(O.overfit_flags(O.overfit_delta(lift), 0.2, threshold=None).collect()) == 3
    whole = lift.withColumn("group", F.lit(1.0)).filter("tag = 'a'").distinct()
    assert len(O.overfit_flags(O.overfit_delta(whole), 1, threshold=None).collect()) == 1
    counts = {(r["test_type"], r["group"]): r for r in O.sales_counts(lift).collect()}
    row = counts[("train", 0.1)]
    assert (row["resp_num_cum_indiv"], row["resp_num_cum_natio"], row["size_cum_indiv"]) == (20, 10, 200)
    first = O.first_deciles(lift, 0.1, 0.1, "test_type", O.TEST_TYPES, ["tag", "group"])
    assert first.count() == 3
    stacked = O.stack({"d02": lift.select("tag", "group"), "d03": lift.select("tag", "gain_cum")})
    assert stacked.count() == 36 and {r["tag"] for r in stacked.collect()} >= {"a_d02", "b_c_d03"}


def test_run_log_rows_of_a_task_are_bounded(spark, tmp_path, monkeypatch):
    """What a task sorts goes by rows, not by compressed bytes; the answers stay the same."""
    monkeypatch.setattr(R, "TASK_ROWS", 50, raising=False)
    path = str(tmp_path / "log")
    R.log_runs(spark, path, [{"run_id": f"r{i}", "params": {"p": i}, "metrics": {"m": [i, i + 0.5]}, "tags": {"t": "x"}} for i in range(100)])
    kv = R.read_log(spark, path)[1]
    assert kv.rdd.getNumPartitions() == 8 and kv.count() == 400
    wide = R.runs_wide(kv, ["m"], ["p"], ["t"])
    assert wide.rdd.getNumPartitions() == 8
    assert {tuple(r) for r in wide.collect()} == {(f"r{i}", i + 0.5, str(i), "x") for i in range(100)}


def test_rows_of_a_training_partition_are_bounded(spark, monkeypatch):
    from liftspark.plans import models as plans

    monkeypatch.setattr(plans, "TRAIN_ROWS", 50, raising=False)
    ready = plans.for_training(spark.range(2000).withColumnRenamed("id", "jobid").coalesce(1))
    sizes = ready.rdd.glom().map(len).collect()
    assert len(sizes) == 40 and max(sizes) < 100 and sum(sizes) == 2000
