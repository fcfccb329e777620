"""Projections, filters and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from liftspark.functions import columns as C
from liftspark.functions import frames as FR
from liftspark.functions.hashing import hash_bucket
from liftspark.operators import runlog
from liftspark.plans.registry import query
from liftspark.plans.tables import (
    H_SQL,
    JOBS_SQL,
    NUMERIC_DIRTY_SQL,
    ORDER_FACTS_SQL,
    RUNS_WIDE_SQL,
    jobs,
    numeric_dirty,
    order_facts,
    run_tables,
    table,
)

VECTOR_SIZE = 64
# Bin edges of the template, and their labels.
CUT_EDGES, CUT_LABELS = (0, 777, 2409, 4952, 26035), (1, 2, 3, 4)


@query("filter_region", f"WITH {JOBS_SQL} SELECT * FROM jobs WHERE region = 'ASIA'")
def filter_region(spark, sf_dir):
    return jobs(spark, sf_dir).filter(F.col("region") == F.lit("ASIA"))


@query(
    "filter_select",
    f"WITH {JOBS_SQL} SELECT jobid, region, competitor_name, competitor_price FROM jobs WHERE region = 'EUROPE'",
)
def filter_select(spark, sf_dir):
    wanted = ["jobid", "region", "competitor_name", "competitor_price"]
    return jobs(spark, sf_dir).filter(F.col("region") == "EUROPE").select(wanted)


@query(
    "dropna_subset",
    f"WITH {JOBS_SQL} SELECT jobid, competitor_name, competitor_price FROM jobs WHERE competitor_name IS NOT NULL AND competitor_price IS NOT NULL",
)
def dropna_subset(spark, sf_dir):
    df = jobs(spark, sf_dir).select("jobid", "competitor_name", "competitor_price")
    return df.dropna(subset=["competitor_name", "competitor_price"])


@query("rename_drop", f"WITH {JOBS_SQL} SELECT jobid AS id, region AS area, competitor_price AS price FROM jobs")
def rename_drop(spark, sf_dir):
    df = jobs(spark, sf_dir).select("jobid", "region", "competitor_price", "dtv_flag")
    return df.drop("dtv_flag").toDF("id", "area", "price")


PROFILE_CLASSES = [
    ("region", "string", "string"),
    ("assignment_start_month", "date", "invalid"),
    ("competitor_name", "string", "string"),
    ("competitor_price", "double", "numeric"),
    ("dtv_flag", "string", "string"),
    ("final_response", "int", "numeric"),
]


@query(
    "schema_profile",
    f"WITH {JOBS_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS type, '{k}' AS class, count({c}) AS n_present FROM jobs"
        for c, t, k in PROFILE_CLASSES
    ),
)
def schema_profile(spark, sf_dir):
    return FR.schema_profile(jobs(spark, sf_dir), exclude=["jobid", "assignment_start_dt"])


@query(
    "fill_by_type",
    f"""WITH {NUMERIC_DIRTY_SQL} SELECT l_orderkey, l_linenumber,
      CASE WHEN quantity IS NULL OR isnan(quantity) THEN 0 ELSE quantity END AS quantity,
      coalesce(line, 0) AS line, coalesce(flag, '') AS flag, is_final
    FROM numeric_dirty""",
)
def fill_by_type(spark, sf_dir):
    return FR.fill_by_type(numeric_dirty(spark, sf_dir), 0, "", skip=["l_orderkey", "l_linenumber"])


@query(
    "fill_sentinel",
    f"""WITH {NUMERIC_DIRTY_SQL} SELECT l_orderkey, l_linenumber,
      CASE WHEN quantity IS NULL OR isnan(quantity) OR isinf(quantity) THEN -9999 ELSE quantity END AS quantity,
      coalesce(line, -9999) AS line, coalesce(flag, '-9999') AS flag, is_final FROM numeric_dirty""",
)
def fill_sentinel(spark, sf_dir):
    return FR.fill_sentinel(numeric_dirty(spark, sf_dir))


@query("drop_tolerant", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def drop_tolerant(spark, sf_dir):
    unwanted = ["o_custkey", "no_such_column", "o_orderstatus", "o_orderdate", "o_custkey"]
    return FR.drop_tolerant(table(spark, sf_dir, "orders"), unwanted)


@query(
    "sanitize_columns",
    'SELECT l_orderkey, l_quantity AS "qty__1__", l_tax AS "tax__5", l_discount AS discount FROM lineitem',
)
def sanitize_columns(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_tax", "l_discount")
    return FR.sanitize_columns(li.toDF("l_orderkey", "qty[1]", "tax<5", "discount"))


@query(
    "sync_columns",
    """SELECT o_orderkey, o_totalprice, -9999 AS o_discount, 0 AS "o_orderstatus__X", o_custkey FROM orders""",
)
def sync_columns(spark, sf_dir):
    train = ["o_totalprice", "o_discount", "o_orderstatus__X", "o_custkey"]
    return FR.sync_columns(
        table(spark, sf_dir, "orders"), train, keep=["o_orderkey"], indicators=["o_orderstatus__X"]
    )


@query(
    "date_parts",
    """SELECT event_id, cast(isodow(ts) - 1 AS INTEGER) AS "ts_DayOfWeek", cast(day(ts) AS INTEGER) AS "ts_DayOfMonth",
      cast(dayofyear(ts) AS INTEGER) AS "ts_DayOfYear", cast(weekofyear(ts) AS INTEGER) AS "ts_WeekOfYear",
      cast(month(ts) AS INTEGER) AS "ts_MonthOfYear" FROM events""",
)
def date_parts(spark, sf_dir):
    return C.date_parts(table(spark, sf_dir, "events").select("event_id", "ts"), "ts")


@query(
    "tag_parse",
    f"""WITH k AS (SELECT o_orderkey, {H_SQL} AS h FROM orders),
    p AS (SELECT o_orderkey, h, CASE h % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'test1' ELSE 'test2' END AS test_type,
      CASE WHEN h % 5 < 3 THEN 'sales' ELSE 'value' END AS capture_type,
      CASE h % 2 WHEN 0 THEN 'mob' ELSE 'all' END AS prod_type FROM k)
    SELECT o_orderkey, test_type, capture_type, prod_type,
      test_type || '_' || prod_type || '_run' || (h % 4) AS tag, cast(h % 10 AS varchar) AS "group",
      CASE WHEN h % 2 = 0 THEN 'price' ELSE 'region' END AS var FROM p""",
)
def tag_parse(spark, sf_dir):
    h = F.col("h")
    key = F.concat_ws(
        "_",
        F.when(h % 3 == 0, "train").when(h % 3 == 1, "test1").otherwise("test2"),
        F.lit("top"),
        F.when(h % 5 < 3, "sales").otherwise("value"),
        F.when(h % 2 == 0, "mob"),
    )
    df = order_facts(spark, sf_dir).select(F.col("jobid").alias("o_orderkey"), "h", key.alias("key"))
    tagged = C.with_lift_tags(df, "key").withColumn("tag", F.concat_ws("_", "test_type", "prod_type"))
    tagged = C.add_run_tag(tagged, F.concat(F.lit("run"), h % 4))
    tagged = tagged.withColumn("group_tag", C.group_tag(h % 10, "tag"))
    split = C.split_group_tag(tagged.drop("tag"))
    var = F.when(h % 2 == 0, "price_imputed").otherwise("region_index")
    return split.select(
        "o_orderkey", "test_type", "capture_type", "prod_type", "tag", "group", C.feature_base_name(var).alias("var")
    )


@query("last_prob", "SELECT vec_id, cast(embedding[-1] AS DOUBLE) AS prob FROM embeddings")
def last_prob(spark, sf_dir):
    df = table(spark, sf_dir, "embeddings")
    return df.select("vec_id", C.last_probability(df, "embedding").alias("prob"))


@query(
    "vector_flatten",
    "SELECT vec_id, label, "
    + ", ".join(f"cast(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(VECTOR_SIZE))
    + " FROM embeddings",
)
def vector_flatten(spark, sf_dir):
    return C.flatten_vector(table(spark, sf_dir, "embeddings"), "embedding", VECTOR_SIZE)


@query(
    "scrub_prediction",
    f"""WITH {ORDER_FACTS_SQL} SELECT jobid, score AS as_propensity, cast(score > 0.5 AS INTEGER) AS as_class,
      predict_int AS as_multiclass,
      CASE WHEN o_totalprice - 250000 < 0 THEN 0 ELSE o_totalprice - 250000 END AS as_regression FROM order_facts""",
)
def scrub_prediction(spark, sf_dir):
    df = order_facts(spark, sf_dir)
    return df.select(
        "jobid",
        C.scrub_prediction("propensity", "predict_int", "score").alias("as_propensity"),
        C.scrub_prediction("classification", "predict_int", "score").alias("as_class"),
        C.scrub_prediction("multiclassClassification", "predict_int").alias("as_multiclass"),
        C.scrub_prediction("regression", F.col("o_totalprice") - 250000).alias("as_regression"),
    )


@query(
    "cut_right_closed",
    """SELECT CASE WHEN l_extendedprice > 0 AND l_extendedprice <= 777 THEN 1
        WHEN l_extendedprice > 777 AND l_extendedprice <= 2409 THEN 2
        WHEN l_extendedprice > 2409 AND l_extendedprice <= 4952 THEN 3
        WHEN l_extendedprice > 4952 AND l_extendedprice <= 26035 THEN 4 END AS bin,
      count(*) AS n, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem GROUP BY 1""",
)
def cut_right_closed(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn("bin", C.cut("l_extendedprice", CUT_EDGES, CUT_LABELS))
    return li.groupBy("bin").agg(
        F.count("*").alias("n"), F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi")
    )


@query(
    "run_names",
    f"""WITH {RUNS_WIDE_SQL} SELECT runs.run_id, coalesce("metric_CG2D", "metric_avg_CG2D") AS metric,
      coalesce(run_name, CASE "param_mlModelClass" WHEN 'RandomForestClassifier' THEN 'RF' WHEN 'LogisticRegression' THEN 'LR'
        WHEN 'LinearSVC' THEN 'SVM' WHEN 'GBTClassifier' THEN 'GBT' ELSE 'Unknown' END
        || '-' || strftime(start_time, '%m%d-%H%M')) || chr(10) || 'id: ' || substr(runs.run_id, 1, 8) AS name
    FROM runs JOIN wide ON runs.run_id = wide.run_id""",
)
def run_names(spark, sf_dir):
    runs, kv = run_tables(spark, sf_dir)
    both = runs.join(runlog.runs_wide(kv, ["CG2D", "avg_CG2D"], ["mlModelClass"]), "run_id")
    return both.select(
        "run_id",
        runlog.metric_or("metric_CG2D", "metric_avg_CG2D").alias("metric"),
        runlog.display_name("run_name", "param_mlModelClass", "start_time", "run_id").alias("name"),
    )


@query(
    "hash_bucket",
    f"SELECT o_orderkey, cast({H_SQL} % 100 AS INTEGER) AS salt, cast({H_SQL} % 3 AS INTEGER) AS fold FROM orders",
)
def hash_bucket_query(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        hash_bucket("o_orderkey", 100, "md5").alias("salt"),
        hash_bucket("o_orderkey", 3, "md5").alias("fold"),
    )
