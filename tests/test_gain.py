import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.linalg import Vectors

from liftspark.operators.gain import GainEvaluator, cumulative_gain, gain_table
from tests import model

SCHEMA = "jobid bigint, score double, final_response int"
COLUMNS = ["group"] + [f"{c}_{s}" for s in ("grp", "cum") for c in ("size", "resp_num", "resp_rate", "gain", "lift")]


def table(spark, rows, **options):
    got = gain_table(spark.createDataFrame(rows, SCHEMA), **options).select(*COLUMNS).collect()
    return sorted(tuple(r) for r in got)


def sample(n, distinct, rate=0.25, seed=3):
    r = random.Random(seed)
    return [(i, r.randrange(distinct) / distinct, int(r.random() < rate)) for i in r.sample(range(5 * n), n)]


@pytest.mark.parametrize("n,distinct", [(1000, 100_000), (1000, 6), (333, 1), (777, 40)])
def test_against_the_definition(spark, small_cells, n, distinct):
    rows = sample(n, distinct)
    assert table(spark, rows) == model.gains(rows)


def test_single_cell(spark):
    rows = sample(500, 50)
    assert table(spark, rows) == model.gains(rows)


def test_one_row_and_empty_bands(spark):
    assert table(spark, [(1, 0.3, 1)]) == model.gains([(1, 0.3, 1)])
    few = [(i, i / 10, i % 2) for i in range(5)]
    got = table(spark, few)
    assert got == model.gains(few)
    assert any(r[1] == 0 and r[3] is None and r[5] is None for r in got)


def test_all_respond(spark, small_cells):
    rows = [(i, i / 100, 1) for i in range(100)]
    assert table(spark, rows) == model.gains(rows)


def test_no_responder(spark):
    rows = [(i, i / 10, 0) for i in range(10)]
    with pytest.raises(ValueError, match="no positive label"):
        table(spark, rows)
    assert all(r[4] is None and r[9] is None for r in table(spark, rows, no_responders="null"))


def test_null_score(spark):
    with pytest.raises(ValueError, match="null or NaN"):
        table(spark, [(1, None, 1), (2, 0.5, 0)])


def test_segments(spark, small_cells):
    rows = sample(600, 12)
    tagged = [(*r, ("hot", "hot", "x", None)[r[0] % 4], r[0] % 2) for r in rows]
    df = spark.createDataFrame(tagged, SCHEMA + ", tag string, side int")
    got = gain_table(df, keys=["tag", "side"]).collect()
    for tag, side in {(r[3], r[4]) for r in tagged}:
        mine = sorted(tuple(r[c] for c in COLUMNS) for r in got if r["tag"] == tag and r["side"] == side)
        assert mine == model.gains([r[:3] for r in tagged if r[3] == tag and r[4] == side])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 9), st.booleans()), min_size=1, max_size=80))
def test_properties(spark, small_cells, drawn):
    rows = [(i, s / 10, int(y)) for i, (s, y) in enumerate(drawn)]
    if not any(r[2] for r in rows):
        rows[0] = (0, rows[0][1], 1)
    got = table(spark, rows)
    gains = [r[9] for r in got]
    assert gains == sorted(gains) and gains[-1] == 1.0
    assert sum(r[1] for r in got) == len(rows) == got[-1][6]
    assert got == model.gains(rows)


def test_evaluator(spark, small_cells, tmp_path):
    rows = sample(400, 30)
    want = model.gains(rows)[7][9]
    df = spark.createDataFrame(
        [(i, Vectors.dense(1 - s, s), [1 - s, s], s, y) for i, s, y in rows],
        ["id", "vector", "list", "number", "label"],
    )
    for col in ("vector", "list", "number"):
        assert GainEvaluator(rawPredictionCol=col, labelCol="label", idCol="id").evaluate(df) == want
    evaluator = GainEvaluator(rawPredictionCol="number", labelCol="label", idCol="id", depth=0.5)
    assert evaluator.isLargerBetter()
    assert evaluator.evaluate(df) == model.gains(rows)[10][9]
    evaluator.write().overwrite().save(str(tmp_path / "evaluator"))
    assert GainEvaluator.load(str(tmp_path / "evaluator")).evaluate(df) == model.gains(rows)[10][9]
    one = cumulative_gain(df.withColumnRenamed("number", "score"), label="label", id="id").first()
    assert one["cg2d"] == want


def test_in_the_library_cross_validator(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    rows = [(i, Vectors.dense(s, -s * s), y) for i, s, y in sample(300, 100, rate=0.4)]
    df = spark.createDataFrame(rows, ["id", "features", "label"])
    estimator = LogisticRegression(maxIter=3)
    evaluator = GainEvaluator(rawPredictionCol="probability", labelCol="label", idCol="id")
    grid = ParamGridBuilder().addGrid(estimator.regParam, [0.0, 0.5]).build()
    fitted = CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, numFolds=2, parallelism=2, seed=1
    ).fit(df)
    assert len(fitted.avgMetrics) == 2 and all(0 <= m <= 1 for m in fitted.avgMetrics)
    predicted = fitted.transform(df)
    assert evaluator.evaluate(predicted, {evaluator.depth: 1.0}) == 1.0
