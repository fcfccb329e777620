import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from liftspark.operators import prefix
from liftspark.operators.prefix import assign_cells, ordered_prefix, plan_cells, prepared
from liftspark.operators.profile import quantiles
from tests import model

SCHEMA = "id bigint, score double, y int"


def sample(n, distinct, seed=1, hot=0.0):
    """Rows with ``distinct`` score levels, a share of them on one hot score."""
    r = random.Random(seed)
    return [
        (i, 0.5 if r.random() < hot else r.randrange(distinct) / distinct, int(r.random() < 0.3))
        for i in r.sample(range(10 * n), n)
    ]


def expected(rows):
    total, out = 0, {}
    for i, row in enumerate(model.ranked(rows)):
        total += row[2]
        out[row[0]] = (i, total)
    return out


@pytest.mark.parametrize("distinct,hot", [(10_000, 0.0), (5, 0.0), (1, 0.0), (1000, 0.4)])
def test_rank_and_running_total(spark, small_cells, distinct, hot):
    rows = sample(400, distinct, hot=hot)
    got = ordered_prefix(spark.createDataFrame(rows, SCHEMA), "score", "id", sums=["y"]).collect()
    assert {r["id"]: (r["row_num"], r["cum_y"]) for r in got} == expected(rows)


def test_result_does_not_depend_on_partitions(spark, small_cells):
    rows = sample(300, 20, hot=0.3)
    df = spark.createDataFrame(rows, SCHEMA)
    a = {tuple(r) for r in ordered_prefix(df.repartition(7), "score", "id").collect()}
    b = {tuple(r) for r in ordered_prefix(df.repartition(1), "score", "id").collect()}
    assert a == b


def test_result_does_not_depend_on_settings(spark, small_cells):
    df = spark.createDataFrame(sample(300, 15, hot=0.3), SCHEMA)
    kept, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for partitions, adaptive in (("1", "true"), ("13", "false")):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            found = ordered_prefix(df, "score", "id", sums=["y"])
            assert dict(found.dtypes)["row_num"] == "bigint"
            seen.append(sorted(tuple(r) for r in found.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert seen[0] == seen[1]


def test_keys_with_null_and_a_hot_key(spark, small_cells):
    rows = [(*r, None if r[0] % 5 == 0 else "big" if r[0] % 5 < 4 else f"k{r[0] % 7}") for r in sample(400, 30)]
    df = spark.createDataFrame(rows, SCHEMA + ", k string")
    got = {(r["k"], r["id"]): r["row_num"] for r in ordered_prefix(df, "score", "id", ["k"]).collect()}
    want = {}
    for k in {r[3] for r in rows}:
        for i, row in enumerate(model.ranked([r[:3] for r in rows if r[3] == k])):
            want[(k, row[0])] = i
    assert got == want


def test_special_values(spark, small_cells):
    inf = float("inf")
    rows = [(i, s, 0) for i, s in enumerate([0.0, -0.0, inf, -inf, 1.0, -0.0, 0.0, inf] * 5)]
    got = ordered_prefix(spark.createDataFrame(rows, SCHEMA), "score", "id").collect()
    assert {r["id"]: r["row_num"] for r in got} == {i: r for i, (r, _) in expected(rows).items()}


@pytest.mark.parametrize("descending", [True, False])
def test_many_extreme_values(spark, small_cells, descending):
    """Infinities and the largest numbers, each on many rows, keep apart and split by id."""
    top = 1.7976931348623157e308
    levels = [float("-inf"), -top, 0.0, top, float("inf")]
    rows = [(i, levels[i * 7 % 5], i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    sign = 1 if descending else -1
    want = {i: r for i, (r, _) in expected([(i, sign * s, y) for i, s, y in rows]).items()}
    got = ordered_prefix(df, "score", "id", descending=descending).collect()
    assert {r["id"]: r["row_num"] for r in got} == want
    cells = plan_cells(prepared(df, "score", "id", [], descending), descending)
    assert len(cells.tied) == 4  # all but the largest number


def test_missing_scores_last_and_split(spark, small_cells):
    rows = [(i, None if i % 3 else i / 100, 0) for i in range(150)]
    got = ordered_prefix(spark.createDataFrame(rows, SCHEMA), "score", "id", nulls="last").collect()
    want = expected([(i, float("-inf") if s is None else s, y) for i, s, y in rows])
    assert {r["id"]: r["row_num"] for r in got} == {i: r for i, (r, _) in want.items()}


def test_key_names(spark):
    from liftspark.operators.gain import gain_table

    df = spark.createDataFrame([(1, 0.5, 1)], "id int, score double, n int")
    with pytest.raises(ValueError, match="rename the key"):
        gain_table(df, label="n", id="id", keys=["n"])


def test_missing_scores(spark):
    df = spark.createDataFrame([(1, None, 0), (2, float("nan"), 1), (3, -5.0, 1)], SCHEMA)
    with pytest.raises(ValueError, match="2 of 3 scores"):
        ordered_prefix(df, "score", "id")
    got = ordered_prefix(df, "score", "id", nulls="last").collect()
    assert {r["id"]: r["row_num"] for r in got} == {3: 0, 1: 1, 2: 2}


@pytest.mark.parametrize("stem", ["", "JOB-2021-é-"])
def test_text_ids(spark, small_cells, stem):
    """Ties order by the text, and split by it where it begins to differ."""
    r = random.Random(4)
    rows = [(f"{stem}{i:x}", r.choice([0.5, 0.5, 0.25]), i % 2) for i in r.sample(range(5000), 300)]
    df = spark.createDataFrame(rows, "id string, score double, y int")
    got = ordered_prefix(df, "score", "id", sums=["y"]).collect()
    assert {r["id"]: (r["row_num"], r["cum_y"]) for r in got} == expected(rows)
    cells = plan_cells(prepared(df, "score", "id", []))
    assert cells.tied and len(cells.id_splits) > 5


def test_other_ids_are_refused(spark):
    with pytest.raises(TypeError, match="number or text"):
        ordered_prefix(spark.createDataFrame([(True, 0.5)], "id boolean, score double"), "score", "id")


@pytest.mark.parametrize("kind", ["bigint", "decimal(38,0)"])
@pytest.mark.parametrize("descending", [True, False])
def test_scores_beyond_the_precision_of_doubles(spark, small_cells, kind, descending):
    big = 2**53
    rows = [(i, big + i * 7 % 40, 1) for i in range(120)]
    df = spark.createDataFrame(rows, "id bigint, score bigint, y int").withColumn("score", F.col("score").cast(kind))
    got = {r["id"]: r["row_num"] for r in ordered_prefix(df, "score", "id", descending=descending).collect()}
    sign = -1 if descending else 1
    assert got == {row[0]: k for k, row in enumerate(sorted(rows, key=lambda r: (sign * r[1], r[0])))}


@pytest.mark.parametrize("distinct,hot", [(1000, 0.0), (1000, 0.5), (3, 0.0), (1, 0.0)])
def test_no_part_is_large(spark, monkeypatch, distinct, hot):
    """A hot score is split by id, also when its ids lie close together."""
    monkeypatch.setattr(prefix, "ROWS_PER_CELL", 100)
    rows = sorted(sample(4000, distinct, hot=hot), key=lambda r: r[1])
    rows = [(i, s, y) for i, (_, s, y) in enumerate(rows)]
    prepared_rows = prepared(spark.createDataFrame(rows, SCHEMA), "score", "id", [])
    cells = plan_cells(prepared_rows)
    sizes = [r["count"] for r in assign_cells(prepared_rows, cells).groupBy(*cells.part).count().collect()]
    assert sum(sizes) == 4000 and max(sizes) <= 400


def test_sampled_split_points(spark, monkeypatch):
    monkeypatch.setattr(prefix, "ROWS_PER_CELL", 50)
    monkeypatch.setattr(prefix, "MIN_SAMPLE", 100)
    monkeypatch.setattr(prefix, "SAMPLE_PER_CELL", 2)
    rows = sample(2000, 100_000)
    got = ordered_prefix(spark.createDataFrame(rows, SCHEMA), "score", "id", sums=["y"]).collect()
    assert {r["id"]: (r["row_num"], r["cum_y"]) for r in got} == expected(rows)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from([0.0, 0.25, 0.5, 1.0, -3.0, 1e300]), min_size=1, max_size=60))
def test_any_scores(spark, small_cells, scores):
    rows = [(i * 3 % 101 + 101 * (i // 101), s, i % 2) for i, s in enumerate(scores)]
    got = ordered_prefix(spark.createDataFrame(rows, SCHEMA), "score", "id", sums=["y"]).collect()
    assert {r["id"]: (r["row_num"], r["cum_y"]) for r in got} == expected(rows)


@pytest.mark.parametrize("values", [[3.5], [1.0, 2.0], [7.0] * 50, [float(i % 13) for i in range(97)]])
def test_quantiles(spark, small_cells, values):
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = {r["prob"]: r["quantile"] for r in quantiles(df, "v", probs).collect()}
    assert got == pytest.approx({p: model.quantile(values, p) for p in probs})


def test_quantiles_by_key(spark, small_cells):
    values = [(k, float((i * 37) % 101)) for k in ("a", "b", None) for i in range(60 if k == "a" else 9)]
    df = spark.createDataFrame(values, "k string, v double")
    got = {(r["k"], r["prob"]): r["quantile"] for r in quantiles(df, "v", [0.25, 0.5], ["k"]).collect()}
    want = {
        (k, p): model.quantile([v for g, v in values if g == k], p) for k in ("a", "b", None) for p in (0.25, 0.5)
    }
    assert got == pytest.approx(want)
