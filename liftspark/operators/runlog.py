"""Run log kept as two tables: one row per run, and one per key and step.

Every append is an attempt with an id of its own. The keys of an attempt count once its runs are listed, so what a lost driver
left half-written is not read; where attempts give one key of a run, the last one does.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from liftspark.session import dealt

#: Rows that one task sorts; a row of a key takes some 120 bytes.
TASK_ROWS = 1_000_000

RUNS_SCHEMA = "run_id string, run_name string, status string, start_time timestamp"
KV_SCHEMA = "run_id string, key string, step int, value double, text string, kind string"
ATTEMPT_SCHEMA = "attempt string, logged_at bigint"

# Short names of the model classes on a leaderboard.
MODEL_CODES = {
    "RandomForestClassifier": "RF",
    "LogisticRegression": "LR",
    "LinearSVC": "SVM",
    "GBTClassifier": "GBT",
}


def kv_rows(run_id: str, params: Mapping, metrics: Mapping, tags: Mapping) -> list[tuple]:
    """Long rows of one run; a metric is a number or a list of numbers by step."""
    rows = [(run_id, k, 0, None, str(v), "param") for k, v in params.items()]
    rows += [(run_id, k, 0, None, str(v), "tag") for k, v in tags.items()]
    for k, v in metrics.items():
        values = v if isinstance(v, (list, tuple)) else [v]
        rows += [(run_id, k, step, float(x), None, "metric") for step, x in enumerate(values)]
    return rows


def log_runs(spark: SparkSession, path: str, runs: Sequence[Mapping]) -> None:
    """Append runs, each with ``run_id``, ``run_name``, ``status``, ``params``, ``metrics``, ``tags``."""
    heads = [
        (r["run_id"], r.get("run_name"), r.get("status", "FINISHED"), r.get("start_time") or datetime.now()) for r in runs
    ]
    rows = [
        row for r in runs for row in kv_rows(r["run_id"], r.get("params", {}), r.get("metrics", {}), r.get("tags", {}))
    ]
    append_log(path, spark.createDataFrame(heads, RUNS_SCHEMA), spark.createDataFrame(rows, KV_SCHEMA))


def append_log(path: str, runs: DataFrame, kv: DataFrame) -> None:
    """Append frames to the log as one attempt; the keys first, so that a listed run is complete."""
    attempt = {"attempt": F.lit(uuid.uuid4().hex), "logged_at": F.lit(time.time_ns())}
    # writing by kind sorts what a task has
    dealt(kv, "run_id", rows=TASK_ROWS).withColumns(attempt).write.mode("append").partitionBy("kind").parquet(f"{path}/run_kv")
    runs.withColumns(attempt).write.mode("append").parquet(f"{path}/runs")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything was logged there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/runs")
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Runs and keys of the complete attempts. A run is listed once, as it was last started; a key and step once, as last logged."""
    runs = spark.read.schema(f"{RUNS_SCHEMA}, {ATTEMPT_SCHEMA}").parquet(f"{path}/runs")
    names = [c.split()[0] for c in RUNS_SCHEMA.split(", ")]
    last = F.max(F.struct("start_time", "logged_at", *names[1:-1])).alias("last")
    once = dealt(runs, "run_id", rows=TASK_ROWS).groupBy("run_id").agg(last).select("run_id", "last.*").select(*names)
    kv = spark.read.schema(f"{KV_SCHEMA}, {ATTEMPT_SCHEMA}").parquet(f"{path}/run_kv")
    parts, of = max(1, -(-kv.count() // TASK_ROWS)), ("run_id", "key", "step", "kind")
    listed = runs.select("run_id", "attempt").repartition(parts, "run_id", "attempt")
    complete = kv.repartition(parts, "run_id", "attempt").join(listed, ["run_id", "attempt"], "left_semi")
    value = F.max_by(F.struct("value", "text"), F.struct("logged_at", "attempt")).alias("v")
    newest = complete.repartition(parts, *of).groupBy(*of).agg(value)
    return once, newest.select("run_id", "key", "step", "v.value", "v.text", "kind")


def runs_wide(
    kv: DataFrame, metrics: Sequence[str] = (), params: Sequence[str] = (), tags: Sequence[str] = ()
) -> DataFrame:
    """One row per run with the latest value of each named key.

    Texts can't be aggregated without sorting the rows, so these are dealt out before they meet, and not sorted by the tasks that read them.
    """

    def latest(kind: str, key: str, col: str) -> Column:
        mine = (F.col("kind") == kind) & (F.col("key") == key)
        return F.max_by(F.when(mine, F.col(col)), F.when(mine, F.col("step"))).alias(f"{kind}_{key}")

    return dealt(kv, "run_id", rows=TASK_ROWS).groupBy("run_id").agg(
        *[latest("metric", k, "value") for k in metrics],
        *[latest("param", k, "text") for k in params],
        *[latest("tag", k, "text") for k in tags],
    )


def best_run(
    runs: DataFrame, metric: str, condition: Column | str | None = None, ascending: bool = False, id: str = "run_id"
) -> DataFrame:
    """The run with the best metric among those that meet the condition."""
    chosen = runs.filter(F.col(metric).isNotNull())
    if condition is not None:
        chosen = chosen.filter(condition)
    by = F.col(metric).asc() if ascending else F.col(metric).desc()
    return chosen.orderBy(by, id).limit(1)


def metric_or(first: str, second: str) -> Column:
    """The first metric, or the second where the first is null or NaN."""
    return F.coalesce(F.nanvl(F.col(first), F.lit(None).cast("double")), F.col(second))


def display_name(name: str, model_class: str, start: str, run_id: str) -> Column:
    """Run name, or the model's short code and start time, and the first part of the id."""
    code = F.lit("Unknown")
    for long, short in MODEL_CODES.items():
        code = F.when(F.col(model_class) == long, F.lit(short)).otherwise(code)
    made = F.concat(code, F.lit("-"), F.date_format(start, "MMdd-HHmm"))
    return F.concat(F.coalesce(F.col(name), made), F.lit("\nid: "), F.substring(run_id, 1, 8))


def leaderboard(runs: DataFrame, metric: str, top: int = 10, id: str = "run_id") -> DataFrame:
    """The best runs that did not fail, in ascending order for display."""
    valid = runs.filter(F.col(metric).isNotNull() & (F.upper("status") != "FAILED"))
    return valid.orderBy(F.col(metric).desc(), id).limit(top).orderBy(F.col(metric).asc(), F.col(id).desc())


def cv_results(scores: DataFrame, params: Sequence[str], score: str) -> DataFrame:
    """Mean and deviation of the fold scores of each parameter set."""
    return scores.groupBy(*params).agg(
        F.avg(score).alias("mean_test_score"),
        F.stddev_pop(score).alias("std_test_score"),
        F.count(score).alias("folds"),
    )
