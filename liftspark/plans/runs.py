"""Run log queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from liftspark.functions.columns import round_half_up
from liftspark.operators import runlog as R
from liftspark.operators.tuning import best_index
from liftspark.plans.registry import query
from liftspark.plans.tables import RUN_KV_SQL, RUNS_WIDE_SQL, r4, run_tables, table
from liftspark.session import scratch_path

WIDE = (["CG2D", "avg_CG2D"], ["learning_rate", "min_child_samples", "mlModelClass"], ["search-type"])


def wide_runs(spark, sf_dir):
    return R.runs_wide(run_tables(spark, sf_dir)[1], *WIDE)


@query("run_log", f"WITH {RUN_KV_SQL} SELECT run_id, key, step, value, text, kind FROM run_kv")
def run_log(spark, sf_dir):
    """Logged in two appends, read back as one table."""
    path = scratch_path(spark, "runlog")
    runs, kv = run_tables(spark, sf_dir)
    R.append_log(path, runs, kv.filter("kind = 'metric'"))
    R.append_log(path, runs, kv.filter("kind <> 'metric'"))
    return R.read_log(spark, path)[1]


@query("runs_wide", f"WITH {RUNS_WIDE_SQL} SELECT * FROM wide")
def runs_wide(spark, sf_dir):
    return wide_runs(spark, sf_dir)


BEST_SQL = """SELECT run_id, "metric_CG2D", param_learning_rate, param_min_child_samples FROM wide
    WHERE "metric_CG2D" IS NOT NULL {where} ORDER BY "metric_CG2D" {order}, run_id LIMIT 1"""
BEST_COLUMNS = ["run_id", "metric_CG2D", "param_learning_rate", "param_min_child_samples"]


@query("best_run", f"WITH {RUNS_WIDE_SQL} {BEST_SQL.format(where='', order='DESC')}")
def best_run(spark, sf_dir):
    return R.best_run(wide_runs(spark, sf_dir), "metric_CG2D").select(BEST_COLUMNS)


@query(
    "best_run_filtered",
    f"WITH {RUNS_WIDE_SQL} "
    + BEST_SQL.format(where="AND param_learning_rate = '0.05' AND param_min_child_samples = '100'", order="ASC"),
)
def best_run_filtered(spark, sf_dir):
    condition = "param_learning_rate = '0.05' and param_min_child_samples = '100'"
    return R.best_run(wide_runs(spark, sf_dir), "metric_CG2D", condition, ascending=True).select(BEST_COLUMNS)


@query(
    "leaderboard",
    f"""WITH {RUNS_WIDE_SQL}, j AS (SELECT runs.run_id, run_name, status,
      coalesce("metric_CG2D", "metric_avg_CG2D") AS metric FROM runs JOIN wide ON runs.run_id = wide.run_id)
    SELECT * FROM j WHERE metric IS NOT NULL AND upper(status) <> 'FAILED' ORDER BY metric DESC, run_id LIMIT 10""",
)
def leaderboard(spark, sf_dir):
    runs, _ = run_tables(spark, sf_dir)
    joined = runs.join(wide_runs(spark, sf_dir), "run_id").select(
        "run_id", "run_name", "status", R.metric_or("metric_CG2D", "metric_avg_CG2D").alias("metric")
    )
    return R.leaderboard(joined, "metric")


def fold_scores(spark, sf_dir):
    """Scores by fold and parameter set: one per customer."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        (k % 3).cast("int").alias("learning_rate"),
        ((k / 3).cast("bigint") % 5).cast("int").alias("min_child_samples"),
        (F.col("c_acctbal") / 10000).alias("score"),
    )


CV_SQL = f"""cv AS (SELECT cast(c_custkey % 3 AS INTEGER) AS learning_rate,
    cast((c_custkey // 3) % 5 AS INTEGER) AS min_child_samples, {r4('avg(c_acctbal / 10000)', 6)} AS mean_test_score,
    {r4('stddev_pop(c_acctbal / 10000)', 6)} AS std_test_score, count(*) AS folds FROM customer GROUP BY 1, 2)"""


def _cv(spark, sf_dir):
    found = R.cv_results(fold_scores(spark, sf_dir), ["learning_rate", "min_child_samples"], "score")
    return found.withColumns({c: round_half_up(c, 6) for c in ("mean_test_score", "std_test_score")})


@query("cv_results", f"WITH {CV_SQL} SELECT * FROM cv")
def cv_results(spark, sf_dir):
    return _cv(spark, sf_dir)


@query(
    "best_params",
    f"""WITH {CV_SQL} SELECT learning_rate, min_child_samples, mean_test_score FROM cv
    ORDER BY mean_test_score DESC, learning_rate, min_child_samples LIMIT 1""",
)
def best_params(spark, sf_dir):
    """The first parameter set of the largest mean, as a search picks it; one row per parameter set reaches the driver."""
    names = ["learning_rate", "min_child_samples", "mean_test_score"]
    rows = _cv(spark, sf_dir).select(names).orderBy(*names[:2]).collect()
    best = rows[best_index([r["mean_test_score"] for r in rows])]
    return spark.createDataFrame([tuple(best)], "learning_rate int, min_child_samples int, mean_test_score double")
