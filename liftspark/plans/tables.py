"""Inputs of the named queries, derived from the given tables.

Every input is defined twice, as a DataFrame and as SQL text for an oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftspark.functions.hashing import md5_number

TRAIN_END = "2000-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: hash, label and scores, all from the order itself."""
    o = table(spark, sf_dir, "orders").withColumn("h", md5_number("o_orderkey"))
    return o.selectExpr(
        "o_orderkey AS jobid",
        "o_custkey",
        "o_totalprice",
        "o_orderdate",
        "o_orderpriority",
        "h",
        "int(floor(o_totalprice / 5000) + h % 100 >= 140) AS final_response",
        "greatest(least(o_totalprice / 500000, 0.9999D), 0.0001D) AS score",
    ).selectExpr("*", "floor(score * 20) / 20 AS score_tied", "int(score > 0.5D) AS predict_int")


H_SQL = "(('0x' || substr(md5(cast(o_orderkey as varchar)), 1, 8))::BIGINT)"

ORDER_FACTS_SQL = f"""order_facts AS (
  SELECT *, least(greatest(floor(score * 20) / 20, -1), 2) AS score_tied,
    cast(score > 0.5 AS INTEGER) AS predict_int
  FROM (
    SELECT o_orderkey AS jobid, o_custkey, o_totalprice, o_orderdate, o_orderpriority, {H_SQL} AS h,
      cast(CASE WHEN floor(o_totalprice / 5000) + {H_SQL} % 100 >= 140 THEN 1 ELSE 0 END AS INTEGER) AS final_response,
      greatest(least(o_totalprice / 500000, CAST(0.9999 AS DOUBLE)), CAST(0.0001 AS DOUBLE)) AS score
    FROM orders))"""


def with_region(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    """Add segment and region of the customer. Nations and regions are tiny fixed lists."""
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    places = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
    who = c.join(places, c.c_nationkey == places.n_nationkey).select(
        "c_custkey", "c_mktsegment", F.col("r_name").alias("region")
    )
    return orders.join(who, orders.o_custkey == who.c_custkey)


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, with nulls in the price and the name."""
    return with_region(spark, sf_dir, order_facts(spark, sf_dir)).selectExpr(
        "jobid",
        "region",
        "date(o_orderdate) AS assignment_start_dt",
        "trunc(date(o_orderdate), 'month') AS assignment_start_month",
        "nullif(c_mktsegment, 'MACHINERY') AS competitor_name",
        "if(h % 17 <> 0, o_totalprice, NULL) AS competitor_price",
        "element_at(array('No', 'Unknown', 'Yes'), int(h % 3 + 1)) AS dtv_flag",
        "final_response",
    )


JOBS_SQL = f"""jobs AS (
  SELECT o_orderkey AS jobid, r_name AS region,
    cast(o_orderdate AS date) AS assignment_start_dt,
    cast(date_trunc('month', o_orderdate) AS date) AS assignment_start_month,
    CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS competitor_name,
    CASE WHEN h % 17 <> 0 THEN o_totalprice END AS competitor_price,
    CASE h % 3 WHEN 0 THEN 'No' WHEN 1 THEN 'Unknown' ELSE 'Yes' END AS dtv_flag,
    cast(CASE WHEN floor(o_totalprice / 5000) + h % 100 >= 140 THEN 1 ELSE 0 END AS INTEGER) AS final_response
  FROM (SELECT *, {H_SQL} AS h FROM orders)
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey)"""


def is_train():
    return F.expr(f"assignment_start_dt < DATE '{TRAIN_END}'")


def tagged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored orders by region, data set and product."""
    return with_region(spark, sf_dir, order_facts(spark, sf_dir)).selectExpr(
        "jobid",
        "final_response",
        "score",
        "element_at(array('train', 'test1', 'test2'), int(h % 3 + 1)) AS test_type",
        "if(h % 2 = 0, 'mob', 'bb') AS prod_type",
        "'sales' AS capture_type",
        "region",
    )


def lift_input(tagged: DataFrame) -> DataFrame:
    """Every order once for its region and once as national."""
    both = F.explode(F.array(F.col("region"), F.lit("national")))
    return tagged.withColumn("tag", both).drop("region")


LIFT_INPUT_SQL = f"""{ORDER_FACTS_SQL}, tagged AS (
  SELECT jobid, final_response, score,
    CASE h % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'test1' ELSE 'test2' END AS test_type,
    CASE h % 2 WHEN 0 THEN 'mob' ELSE 'bb' END AS prod_type, 'sales' AS capture_type, r_name AS region
  FROM order_facts JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
lift_input AS (
  SELECT jobid, final_response, score, test_type, prod_type, capture_type, region AS tag FROM tagged
  UNION ALL
  SELECT jobid, final_response, score, test_type, prod_type, capture_type, 'national' AS tag FROM tagged)"""


def numeric_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with missing and non-finite quantities."""
    li = table(spark, sf_dir, "lineitem")
    h = md5_number(F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    return li.withColumn("h", h).select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("h") % 20 == 0, None)
        .when(F.col("h") % 20 == 1, F.lit(float("nan")))
        .when(F.col("h") % 20 == 2, F.lit(float("inf")))
        .when(F.col("h") % 20 == 3, F.lit(float("-inf")))
        .otherwise(F.col("l_quantity"))
        .alias("quantity"),
        F.when(F.col("h") % 7 != 0, F.col("l_linenumber")).alias("line"),
        F.when(F.col("h") % 5 != 0, F.col("l_returnflag")).alias("flag"),
        F.when(F.col("h") % 3 != 0, F.col("l_linestatus") == "F").alias("is_final"),
    )


NUMERIC_DIRTY_SQL = """numeric_dirty AS (
  SELECT l_orderkey, l_linenumber,
    CASE h % 20 WHEN 0 THEN NULL WHEN 1 THEN 'nan'::DOUBLE WHEN 2 THEN 'inf'::DOUBLE
      WHEN 3 THEN '-inf'::DOUBLE ELSE l_quantity END AS quantity,
    CASE WHEN h % 7 <> 0 THEN l_linenumber END AS line,
    CASE WHEN h % 5 <> 0 THEN l_returnflag END AS flag,
    CASE WHEN h % 3 <> 0 THEN l_linestatus = 'F' END AS is_final
  FROM (SELECT *, ('0x' || substr(md5(cast(l_orderkey * 8 + l_linenumber AS varchar)), 1, 8))::BIGINT AS h
        FROM lineitem))"""


def user_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types per user, scored by total value in coarse steps, so that many tie, relevant from two events on."""
    e = table(spark, sf_dir, "events")
    return (
        e.groupBy("user_id", "event_type")
        .agg(F.sum(F.floor(F.col("value") / 100).cast("bigint")).alias("total"), F.count("*").alias("n"))
        .select("user_id", "event_type", "total", (F.col("n") >= 2).cast("int").alias("relevant"))
    )


def run_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A run log with one run per customer: the runs, and their keys in long form."""
    c = table(spark, sf_dir, "customer").withColumn("run_id", F.concat(F.lit("run-"), F.col("c_custkey")))
    k = F.col("c_custkey")
    failed = F.when(F.col("c_mktsegment") == "BUILDING", "failed").otherwise("FINISHED")
    runs = c.select(
        "run_id",
        F.when(k % 4 == 0, F.concat(F.lit("grid-"), k)).alias("run_name"),
        failed.alias("status"),
        F.expr("timestampadd(SECOND, int(c_custkey * 61), TIMESTAMP_NTZ'2022-01-01 00:00:00')").alias("start_time"),
    )
    balance = F.col("c_acctbal")
    model = F.element_at(
        F.array(*[F.lit(m) for m in ("RandomForestClassifier", "LogisticRegression", "LinearSVC", "GBTClassifier", "Other")]),
        (k % 5 + 1).cast("int"),
    )

    def entry(kind: str, key: str, step: int, value=None, text=None):
        return F.struct(
            F.lit(key).alias("key"),
            F.lit(step).alias("step"),
            (F.lit(None).cast("double") if value is None else value).alias("value"),
            (F.lit(None).cast("string") if text is None else text).alias("text"),
            F.lit(kind).alias("kind"),
        )

    cg2d = F.when(F.col("c_mktsegment") != "FURNITURE", balance)
    entries = F.array(
        *[entry("metric", "CG2D", s, value=cg2d * (s + 1) / 10000) for s in range(3)],
        entry("metric", "avg_CG2D", 0, value=balance / 20000),
        entry("param", "learning_rate", 0, text=F.element_at(F.array(F.lit("0.1"), F.lit("0.05"), F.lit("0.01")), (k % 3 + 1).cast("int"))),
        entry("param", "min_child_samples", 0, text=F.element_at(F.array(*[F.lit(v) for v in ("30", "50", "100", "300", "400")]), ((k / 3).cast("bigint") % 5 + 1).cast("int"))),
        entry("param", "mlModelClass", 0, text=model),
        entry("tag", "search-type", 0, text=F.when(k % 2 == 0, "grid").otherwise("hyperopt")),
    )
    return runs, c.select("run_id", F.inline(entries))


RUNS_SQL = """runs AS (
  SELECT 'run-' || c_custkey AS run_id, CASE WHEN c_custkey % 4 = 0 THEN 'grid-' || c_custkey END AS run_name,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'failed' ELSE 'FINISHED' END AS status,
    make_timestamp((1640995200 + c_custkey * 61) * 1000000) AS start_time
  FROM customer)"""

RUN_KV_SQL = """kv_base AS (
  SELECT 'run-' || c_custkey AS run_id, c_custkey AS k, c_acctbal AS balance,
    CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_acctbal END AS cg FROM customer),
run_kv AS (
  SELECT run_id, 'CG2D' AS key, s AS step, cg * (s + 1) / 10000 AS value, NULL AS text, 'metric' AS kind
    FROM kv_base, (SELECT unnest([0, 1, 2]) AS s)
  UNION ALL SELECT run_id, 'avg_CG2D', 0, balance / 20000, NULL, 'metric' FROM kv_base
  UNION ALL SELECT run_id, 'learning_rate', 0, NULL, ['0.1', '0.05', '0.01'][k % 3 + 1], 'param' FROM kv_base
  UNION ALL SELECT run_id, 'min_child_samples', 0, NULL, ['30', '50', '100', '300', '400'][(k // 3) % 5 + 1], 'param' FROM kv_base
  UNION ALL SELECT run_id, 'mlModelClass', 0, NULL,
    ['RandomForestClassifier', 'LogisticRegression', 'LinearSVC', 'GBTClassifier', 'Other'][k % 5 + 1], 'param' FROM kv_base
  UNION ALL SELECT run_id, 'search-type', 0, NULL, CASE WHEN k % 2 = 0 THEN 'grid' ELSE 'hyperopt' END, 'tag' FROM kv_base)"""

RUNS_WIDE_SQL = f"""{RUNS_SQL}, {RUN_KV_SQL}, wide AS (
  SELECT run_id,
    max(value) FILTER (key = 'CG2D' AND step = 2) AS "metric_CG2D",
    max(value) FILTER (key = 'avg_CG2D') AS "metric_avg_CG2D",
    max(text) FILTER (key = 'learning_rate') AS param_learning_rate,
    max(text) FILTER (key = 'min_child_samples') AS param_min_child_samples,
    max(text) FILTER (key = 'mlModelClass') AS "param_mlModelClass",
    max(text) FILTER (key = 'search-type') AS "tag_search-type"
  FROM run_kv GROUP BY run_id)"""


def r4(expression: str, digits: int = 4) -> str:
    """SQL text of half-up rounding on doubles."""
    scale = 10**digits
    return f"(floor(({expression}) * CAST({scale} AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST({scale} AS DOUBLE))"
