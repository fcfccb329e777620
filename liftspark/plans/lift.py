"""Ranking, gain tables, curves, metrics and the comparison of lift tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from liftspark.functions.columns import round_half_up, rounded
from liftspark.operators import curves, increments, metrics, models, overfit
from liftspark.operators import gain as G
from liftspark.operators.prefix import ordered_prefix
from liftspark.operators.profile import wide
from liftspark.plans.registry import query
from liftspark.plans.tables import (
    LIFT_INPUT_SQL,
    ORDER_FACTS_SQL,
    lift_input,
    order_facts,
    r4,
    table,
    tagged_orders,
    user_types,
)
from liftspark.session import checkpointed, scratch_path

EDGES_SQL = "[" + ", ".join(str(e) for e in G.GAIN_EDGES) + "]"
SEGMENTS = list(overfit.SEGMENT_KEYS)


def gain_sql(source: str, score: str = "score", keys: list[str] | None = None) -> str:
    """CTEs that end in ``gains``, by ranking all rows and scanning them per band."""
    keys = keys or []
    k = "".join(f"{c}, " for c in keys)
    by = f"PARTITION BY {', '.join(keys)}" if keys else ""
    return f"""edges AS (SELECT hi, lag(hi, 1, CAST(0 AS DOUBLE)) OVER (ORDER BY hi) AS lo
      FROM (SELECT unnest({EDGES_SQL})::DOUBLE AS hi)),
    ranked AS (SELECT {k}final_response AS y, row_number() OVER ({by} ORDER BY {score} DESC, jobid) - 1 AS rn,
      count(*) OVER ({by}) AS n, sum(final_response) OVER ({by}) AS total FROM {source}),
    bands AS (SELECT {k}hi, any_value(n)::DOUBLE AS n, any_value(total)::DOUBLE AS total,
      count(*) FILTER (rn >= lo * n) AS size_grp, coalesce(sum(y) FILTER (rn >= lo * n), 0)::BIGINT AS resp_num_grp,
      count(*) AS size_cum, sum(y)::BIGINT AS resp_num_cum
      FROM ranked JOIN edges ON rn < hi * n GROUP BY {k}hi),
    gains AS (SELECT {k}hi AS "group", size_grp, resp_num_grp,
      {r4('resp_num_grp::DOUBLE / nullif(size_grp, 0)')} AS resp_rate_grp,
      {r4('resp_num_grp::DOUBLE / total')} AS gain_grp,
      {r4('(resp_num_grp::DOUBLE / total) * (n / nullif(size_grp, 0))')} AS lift_grp,
      size_cum, resp_num_cum, {r4('resp_num_cum::DOUBLE / size_cum')} AS resp_rate_cum,
      {r4('resp_num_cum::DOUBLE / total')} AS gain_cum,
      {r4('(resp_num_cum::DOUBLE / total) * (n / size_cum)')} AS lift_cum FROM bands)"""


GAIN_SQL = f"WITH {ORDER_FACTS_SQL}, {gain_sql('order_facts')}"
LIFT_LONG_SQL = f"WITH {LIFT_INPUT_SQL}, {gain_sql('lift_input', keys=SEGMENTS)}"


def scored(spark, sf_dir):
    return order_facts(spark, sf_dir).select("jobid", "final_response", "score", "score_tied", "predict_int")


def lift_long(spark, sf_dir):
    # the joined rows are read several times, so they are stored first
    rows = checkpointed(tagged_orders(spark, sf_dir))
    return overfit.gain_by_segment(lift_input(rows), "score", "final_response", "jobid")


@query(
    "global_rank",
    f"WITH {ORDER_FACTS_SQL} SELECT jobid, score, row_number() OVER (ORDER BY score DESC, jobid) - 1 AS row_num FROM order_facts",
)
def global_rank(spark, sf_dir):
    return ordered_prefix(scored(spark, sf_dir).select("jobid", "score"), "score", "jobid")


@query(
    "global_rank_tied",
    f"""WITH {ORDER_FACTS_SQL} SELECT jobid, score_tied, row_number() OVER (ORDER BY score_tied DESC, jobid) - 1 AS row_num,
      (sum(final_response) OVER (ORDER BY score_tied DESC, jobid ROWS UNBOUNDED PRECEDING))::BIGINT AS cum_final_response
    FROM order_facts""",
)
def global_rank_tied(spark, sf_dir):
    rows = scored(spark, sf_dir).select("jobid", "score_tied", "final_response")
    return ordered_prefix(rows, "score_tied", "jobid", sums=["final_response"]).drop("final_response")


@query("gain_table", f"{GAIN_SQL} SELECT * FROM gains")
def gain_table(spark, sf_dir):
    return G.gain_table(scored(spark, sf_dir))


@query("gain_table_incremental", f"{GAIN_SQL} SELECT * FROM gains")
def gain_table_incremental(spark, sf_dir):
    """The orders of each year added as a part of its own; the table over all parts."""
    path, rows = scratch_path(spark, "parts"), checkpointed(scored(spark, sf_dir).join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("jobid"), F.year("o_orderdate").alias("year")), "jobid"))
    years = [r["year"] for r in rows.select("year").distinct().orderBy("year").collect()]
    for year in years:
        increments.add_part(rows.filter(F.col("year") == year), path, str(year))
    return increments.gain_table_of(spark, path)


@query("gain_table_tied", f"WITH {ORDER_FACTS_SQL}, {gain_sql('order_facts', 'score_tied')} SELECT * FROM gains")
def gain_table_tied(spark, sf_dir):
    return G.gain_table(scored(spark, sf_dir), "score_tied")


@query("cg2d", f'{GAIN_SQL} SELECT gain_cum AS cg2d FROM gains WHERE "group" = CAST(0.2 AS DOUBLE)')
def cg2d(spark, sf_dir):
    return G.cumulative_gain(scored(spark, sf_dir))


@query("gain_by_segment", f"{LIFT_LONG_SQL} SELECT * FROM gains")
def gain_by_segment(spark, sf_dir):
    return lift_long(spark, sf_dir)


FIRST_SQL = """ FROM gains WHERE "group" BETWEEN CAST(0.1 AS DOUBLE) AND CAST(0.4 AS DOUBLE) GROUP BY ALL"""


@query(
    "first_n_deciles",
    f"""{LIFT_LONG_SQL} SELECT test_type, capture_type, prod_type, "group",
      max(gain_cum) FILTER (tag = 'AFRICA') AS "AFRICA", max(gain_cum) FILTER (tag = 'AMERICA') AS "AMERICA",
      max(gain_cum) FILTER (tag = 'ASIA') AS "ASIA", max(gain_cum) FILTER (tag = 'EUROPE') AS "EUROPE",
      max(gain_cum) FILTER (tag = 'MIDDLE EAST') AS "MIDDLE EAST", max(gain_cum) FILTER (tag = 'national') AS national
    {FIRST_SQL}""",
)
def first_n_deciles(spark, sf_dir):
    tags = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "national"]
    index = ["test_type", "capture_type", "prod_type", "group"]
    return overfit.first_deciles(lift_long(spark, sf_dir), 0.1, 0.4, "tag", tags, index)


@query(
    "lift_pivot",
    f"""{LIFT_LONG_SQL} SELECT tag, capture_type, prod_type, "group", max(lift_cum) FILTER (test_type = 'train') AS train,
      max(lift_cum) FILTER (test_type = 'test1') AS test1, max(lift_cum) FILTER (test_type = 'test2') AS test2
    FROM gains GROUP BY ALL""",
)
def lift_pivot(spark, sf_dir):
    index = ["tag", "capture_type", "prod_type", "group"]
    return wide(lift_long(spark, sf_dir), index, "test_type", "lift_cum", overfit.TEST_TYPES)


@query(
    "sales_counts_compare",
    f"""{LIFT_LONG_SQL} SELECT prod_type, test_type, "group",
      sum(size_cum) FILTER (tag <> 'national')::BIGINT AS size_cum_indiv,
      sum(resp_num_cum) FILTER (tag <> 'national')::BIGINT AS resp_num_cum_indiv,
      sum(size_cum) FILTER (tag = 'national')::BIGINT AS size_cum_natio,
      sum(resp_num_cum) FILTER (tag = 'national')::BIGINT AS resp_num_cum_natio
    FROM gains WHERE "group" >= CAST(0.1 AS DOUBLE) GROUP BY ALL""",
)
def sales_counts_compare(spark, sf_dir):
    return overfit.sales_counts(lift_long(spark, sf_dir))


DELTA_SQL = f"""{LIFT_LONG_SQL}, wide AS (SELECT "group", tag,
    max(gain_cum) FILTER (test_type = 'train') AS train, max(gain_cum) FILTER (test_type = 'test1') AS test1,
    max(gain_cum) FILTER (test_type = 'test2') AS test2
  FROM gains WHERE capture_type = 'sales' AND prod_type = 'mob' GROUP BY ALL),
delta AS (SELECT train, test1, test2, {r4('(test1 - train) / nullif(train, 0)')} AS train_test1,
  {r4('(test2 - train) / nullif(train, 0)')} AS train_test2, "group", tag FROM wide)"""


def _delta(spark, sf_dir):
    found = overfit.overfit_delta(lift_long(spark, sf_dir))
    return rounded(found, ["train_test1", "train_test2"])


@query("overfit_delta", f"{DELTA_SQL} SELECT * FROM delta")
def overfit_delta(spark, sf_dir):
    return _delta(spark, sf_dir)


@query(
    "overfit_flags",
    f"""{DELTA_SQL} SELECT * FROM delta WHERE "group" = 0.2 AND train_test1 > CAST(-0.02 AS DOUBLE)
    ORDER BY train_test1 DESC, tag""",
)
def overfit_flags(spark, sf_dir):
    return overfit.overfit_flags(_delta(spark, sf_dir), 0.2)


@query(
    "metric_change",
    f"""WITH {LIFT_INPUT_SQL}, m AS (SELECT tag, test_type, sum(final_response)::DOUBLE / count(*) AS metric
      FROM lift_input GROUP BY ALL),
    w AS (SELECT tag, max(metric) FILTER (test_type = 'train') AS train, max(metric) FILTER (test_type = 'test1') AS test1,
      max(metric) FILTER (test_type = 'test2') AS test2 FROM m GROUP BY tag)
    SELECT tag, {r4('(test1 - train) / train')} AS train_test1, {r4('(test2 - train) / train')} AS train_test2 FROM w""",
)
def metric_change(spark, sf_dir):
    rate = F.sum("final_response").cast("double") / F.count("*")
    per_set = lift_input(tagged_orders(spark, sf_dir)).groupBy("tag", "test_type").agg(rate.alias("metric"))
    changed = overfit.relative_change(wide(per_set, ["tag"], "test_type", "metric", overfit.TEST_TYPES))
    return changed.select("tag", *[round_half_up(c).alias(c) for c in ("train_test1", "train_test2")])


@query(
    "lift_stack",
    f"""WITH {ORDER_FACTS_SQL}, a AS (
      WITH {gain_sql('order_facts', 'score')} SELECT 'national_fine' AS tag, "group", gain_cum, lift_cum FROM gains),
    b AS (WITH {gain_sql('order_facts', 'score_tied')} SELECT 'national_coarse' AS tag, "group", gain_cum, lift_cum FROM gains)
    SELECT * FROM a UNION ALL SELECT * FROM b""",
)
def lift_stack(spark, sf_dir):
    rows = scored(spark, sf_dir)

    def lifts(score):
        table = G.gain_table(rows, score)
        return table.select(F.lit("national").alias("tag"), "group", "gain_cum", "lift_cum")

    return overfit.stack({"fine": lifts("score"), "coarse": lifts("score_tied")})


AUC_SQL = """c AS (SELECT {s} AS s, sum(final_response)::HUGEINT AS pos, sum(1 - final_response)::HUGEINT AS neg
  FROM order_facts GROUP BY 1),
a AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM c)
SELECT {r} AS auc FROM a"""
AUC_VALUE = "sum(pos * (2 * below + neg))::DOUBLE / (2 * sum(pos) * sum(neg))::DOUBLE"


def _auc_sql(score: str) -> str:
    return f"WITH {ORDER_FACTS_SQL}, " + AUC_SQL.format(s=score, r=r4(AUC_VALUE, 6))


@query("auc_score", _auc_sql("score"))
def auc_score(spark, sf_dir):
    return curves.auc(scored(spark, sf_dir), "score", "final_response").select(round_half_up("auc", 6).alias("auc"))


@query("auc_hard", _auc_sql("predict_int"))
def auc_hard(spark, sf_dir):
    return curves.auc(scored(spark, sf_dir), "predict_int", "final_response").select(round_half_up("auc", 6).alias("auc"))


POINTS_SQL = f"""WITH {ORDER_FACTS_SQL}, c AS (SELECT score AS t, sum(final_response) AS pos, sum(1 - final_response) AS neg
  FROM order_facts GROUP BY 1),
p AS (SELECT t, pos, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS np, sum(neg) OVER () AS nn
  FROM c WINDOW w AS (ORDER BY t DESC ROWS UNBOUNDED PRECEDING))"""


def _rounded(df, *cols, digits=6):
    return rounded(df, cols, digits)


@query(
    "roc_curve",
    f"""{POINTS_SQL}, s AS (SELECT *, fp - lag(fp, 1, 0) OVER w AS df, tp - lag(tp, 1, 0) OVER w AS dt,
      lead(fp) OVER w - fp AS nf, lead(tp) OVER w - tp AS nt, row_number() OVER w AS i FROM p WINDOW w AS (ORDER BY t DESC))
    SELECT {r4('fp::DOUBLE / nn', 6)} AS fpr, {r4('tp::DOUBLE / np', 6)} AS tpr, t AS threshold FROM s
    WHERE i = 1 OR nf IS NULL OR nf <> df OR nt <> dt UNION ALL SELECT 0, 0, NULL""",
)
def roc_curve(spark, sf_dir):
    return _rounded(curves.roc_curve(scored(spark, sf_dir), "score", "final_response"), "fpr", "tpr")


@query(
    "roc_curve_full",
    f"""{POINTS_SQL} SELECT {r4('fp::DOUBLE / nn', 6)} AS fpr, {r4('tp::DOUBLE / np', 6)} AS tpr, t AS threshold FROM p
    UNION ALL SELECT 0, 0, NULL""",
)
def roc_curve_full(spark, sf_dir):
    full = curves.roc_curve(scored(spark, sf_dir), "score", "final_response", drop_intermediate=False)
    return _rounded(full, "fpr", "tpr")


@query(
    "pr_curve",
    f"""{POINTS_SQL} SELECT {r4('tp::DOUBLE / (tp + fp)', 6)} AS precision, {r4('tp::DOUBLE / np', 6)} AS recall,
      t AS threshold FROM p UNION ALL SELECT 1, 0, NULL""",
)
def pr_curve(spark, sf_dir):
    return _rounded(curves.precision_recall_curve(scored(spark, sf_dir), "score", "final_response"), "precision", "recall")


@query(
    "det_curve",
    f"""{POINTS_SQL}, q AS (SELECT *, lead(fp) OVER (ORDER BY t DESC) AS next_fp, min(fp) OVER () AS first_fp FROM p)
    SELECT {r4('fp::DOUBLE / nn', 6)} AS fpr, {r4('(np - tp)::DOUBLE / np', 6)} AS fnr, t AS threshold FROM q
    WHERE (fp > first_fp OR next_fp > first_fp OR next_fp IS NULL) AND tp - pos < np""",
)
def det_curve(spark, sf_dir):
    return _rounded(curves.det_curve(scored(spark, sf_dir), "score", "final_response"), "fpr", "fnr")


@query(
    "mean_avg_precision",
    f"""WITH u AS (SELECT user_id, event_type, sum(floor(value / 100)::BIGINT) AS total, count(*) >= 2 AS rel FROM events GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY total DESC, event_type) AS rk FROM u),
    h AS (SELECT *, sum(rel::INT) OVER (PARTITION BY user_id ORDER BY rk) AS hits FROM r),
    a AS (SELECT user_id, coalesce(sum(CASE WHEN rel THEN hits::DOUBLE / rk END) / nullif(sum(rel::INT), 0), 0) AS ap FROM h GROUP BY 1)
    SELECT {r4('avg(ap)')} AS mean_avg_precision, count(*) AS n_queries FROM a""",
)
def mean_avg_precision(spark, sf_dir):
    pairs = checkpointed(user_types(spark, sf_dir))
    found = curves.mean_average_precision(pairs, "user_id", "event_type", "total", "relevant")
    return found.withColumn("mean_avg_precision", round_half_up("mean_avg_precision"))


MAP_SQL = f"""u AS (SELECT user_id, event_type, sum(floor(value / 100)::BIGINT) AS total, count(*) >= 2 AS rel FROM events GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY total DESC, user_id) AS rk FROM u),
    h AS (SELECT *, sum(rel::INT) OVER (PARTITION BY event_type ORDER BY rk) AS hits FROM r),
    a AS (SELECT event_type, coalesce(sum(CASE WHEN rel THEN hits::DOUBLE / rk END) / nullif(sum(rel::INT), 0), 0) AS ap FROM h GROUP BY 1)"""


@query("map_evaluator", f"WITH {MAP_SQL} SELECT {r4('avg(ap)')} AS value FROM a")
def map_evaluator(spark, sf_dir):
    """The evaluator of ranked lists on scores that no model made: users ranked within each kind of event."""
    pairs = checkpointed(user_types(spark, sf_dir))
    judge = models.evaluator("mAP", "relevant", "user_id", query="event_type")
    value = judge.evaluate(pairs.withColumn(models.predict_col("prob"), F.col("total").cast("double")))
    return spark.createDataFrame([(value,)], "value double").withColumn("value", round_half_up("value"))


@query(
    "confusion_matrix",
    f"WITH {ORDER_FACTS_SQL} SELECT final_response, predict_int, count(*) AS n FROM order_facts GROUP BY ALL",
)
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(scored(spark, sf_dir), "final_response", "predict_int")


@query(
    "binary_metrics",
    f"""WITH {ORDER_FACTS_SQL}, c AS (SELECT count(*) FILTER (final_response = 1 AND predict_int = 1)::DOUBLE AS tp,
      count(*) FILTER (predict_int = 1) AS said, count(*) FILTER (final_response = 1) AS yes,
      count(*) FILTER (final_response = predict_int)::DOUBLE AS same, count(*) AS n FROM order_facts)
    SELECT {r4('tp / said', 6)} AS precision, {r4('tp / yes', 6)} AS recall, {r4('same / n', 6)} AS accuracy,
      {r4('2 * tp / (said + yes)', 6)} AS f1 FROM c""",
)
def binary_metrics(spark, sf_dir):
    found = metrics.binary_metrics(scored(spark, sf_dir), "final_response", "predict_int")
    return _rounded(found, "precision", "recall", "accuracy", "f1")


@query(
    "multiclass_metrics",
    f"""WITH {ORDER_FACTS_SQL}, c AS (SELECT substr(o_orderpriority, 1, 1)::INT AS actual, h % 5 + 1 AS said FROM order_facts),
    m AS (SELECT count(*) FILTER (actual = said)::DOUBLE / count(*) AS v FROM c)
    SELECT {r4('v', 6)} AS precision, {r4('v', 6)} AS recall, {r4('v', 6)} AS accuracy, {r4('v', 6)} AS f1 FROM m""",
)
def multiclass_metrics(spark, sf_dir):
    rows = order_facts(spark, sf_dir).select(
        F.substring("o_orderpriority", 1, 1).cast("int").alias("actual"), (F.col("h") % 5 + 1).alias("said")
    )
    return _rounded(metrics.multiclass_metrics(rows, "actual", "said"), "precision", "recall", "accuracy", "f1")


@query(
    "log_loss",
    f"""WITH {ORDER_FACTS_SQL} SELECT {r4('avg(-ln(CASE WHEN final_response = 1 THEN score ELSE 1 - score END))')} AS log_loss
    FROM order_facts""",
)
def log_loss(spark, sf_dir):
    return rounded(metrics.log_loss(scored(spark, sf_dir), "final_response", "score"), ["log_loss"])


REGRESSION_SQL = "l_quantity * 2100 + l_discount * 1000 - l_tax * 500"


@query(
    "regression_metrics",
    f"""WITH p AS (SELECT l_extendedprice AS y, {REGRESSION_SQL} AS p FROM lineitem),
    m AS (SELECT avg(y) AS mean FROM p),
    s AS (SELECT avg((y - p) * (y - p)) AS mse, avg((y - mean) * (y - mean)) AS var FROM p, m)
    SELECT {r4('mse', 2)} AS mse, {r4('1 - mse / var')} AS r2 FROM s""",
)
def regression_metrics(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn("p", F.expr(REGRESSION_SQL))
    found = metrics.regression_metrics(li, "l_extendedprice", "p")
    return found.select(round_half_up("mse", 2).alias("mse"), round_half_up("r2").alias("r2"))
