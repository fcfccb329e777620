"""Gain tables of parts against those of all rows."""

import math
import random

import pytest

from liftspark.operators import increments as I
from liftspark.operators.gain import gain_table
from tests import model
from tests.test_gain import COLUMNS, SCHEMA


def rows_of(seed, n, distinct, ids):
    r = random.Random(seed)
    return [(ids + i, r.randrange(distinct + 1) / distinct, int(r.random() < 0.3)) for i in range(n)]


@pytest.mark.parametrize(("distinct", "number"), [(1, 16), (7, 4096), (100_000, 1), (100_000, 256)])
def test_parts_add_up(spark, tmp_path, distinct, number):
    cells, path, every = I.Cells(0.0, 1.0, number), str(tmp_path / "s"), []
    for p in range(3):
        part = rows_of(p, 300 + p, distinct, 1000 * p)
        every += part
        I.add_part(spark.createDataFrame(part, SCHEMA).repartition(3), path, f"2020-0{p + 1}", cells=cells)
        if p == 2 or distinct == 7:
            got = sorted(tuple(x) for x in I.gain_table_of(spark, path, cells=cells).select(*COLUMNS).collect())
            assert got == model.gains(every)
    ordered = sorted(s for _, s, _ in every)
    shares = [0, 0.1, 0.25, 0.5, 0.501, 0.99, 1]
    assert I.quantiles_of(spark, path, shares, cells=cells) == [ordered[max(1, math.ceil(q * len(ordered))) - 1] for q in shares]
    some = [x for p in (0, 2) for x in rows_of(p, 300 + p, distinct, 1000 * p)]
    got = I.gain_table_of(spark, path, parts=["2020-01", "2020-03"], cells=cells).select(*COLUMNS).collect()
    assert sorted(map(tuple, got)) == model.gains(some)


def test_outside_scores_and_parts_written_anew(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = [(i, (i - 50) / 25, i % 2) for i in range(100)]  # beyond 0 and 1 too
    I.add_part(spark.createDataFrame(rows[:60], SCHEMA), path, "a")
    I.add_part(spark.createDataFrame(rows[:50], SCHEMA), path, "a")
    I.add_part(spark.createDataFrame(rows[50:], SCHEMA), path, "b")
    want = sorted(map(tuple, gain_table(spark.createDataFrame(rows, SCHEMA)).select(*COLUMNS).collect()))
    assert sorted(map(tuple, I.gain_table_of(spark, path).select(*COLUMNS).collect())) == want
    for bad in (None, math.nan):
        with pytest.raises(ValueError):
            I.add_part(spark.createDataFrame([(1, bad, 1)], SCHEMA), path, "c")
    I.add_part(spark.createDataFrame([(1, 0.5, 0)], SCHEMA), str(tmp_path / "none"), "a")
    with pytest.raises(ValueError):
        I.gain_table_of(spark, str(tmp_path / "none"))


def test_only_divided_cells_are_read(spark, tmp_path):
    path, n = str(tmp_path / "s"), 20_000
    rows = spark.range(n).selectExpr("id AS jobid", f"id / {n}D AS score", "int(id % 3 = 0) AS final_response")
    I.add_part(rows, path, "a")
    cells = I.Cells()
    read = I._rows(spark, path, None, [5, 900], cells)
    assert read.count() == sum(int(i / n * cells.number) in (5, 900) for i in range(n))
    text = read._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in text and "GreaterThanOrEqual(score" in text
