"""Feature engineering queries."""

from __future__ import annotations

from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.sql import functions as F

from liftspark.functions.columns import flatten_vector, round_half_up, rounded
from liftspark.operators import encoding
from liftspark.operators import features as FE
from liftspark.plans.registry import query
from liftspark.plans.tables import JOBS_SQL, TRAIN_END, is_train, jobs, r4, table
from liftspark.session import checkpointed

SIZE = 64
NOT_FEATURES = ["jobid", "final_response", "assignment_start_dt", "assignment_start_month"]


def filled_jobs(spark, sf_dir):
    return jobs(spark, sf_dir).fillna({"competitor_name": "", "competitor_price": 0.0})


def gold_pipeline(spark, sf_dir):
    """Fit the feature pipeline on the training rows; return it with all rows.

    Fitting and training read the rows many times over, so the join is stored
    once, in files of even size.
    """
    df = checkpointed(filled_jobs(spark, sf_dir).hint("rebalance"))
    train = df.filter(is_train())
    return FE.feature_pipeline(train, NOT_FEATURES).fit(train), df


@query(
    "string_index",
    f"""WITH {JOBS_SQL} SELECT jobid, (dense_rank() OVER (ORDER BY region) - 1)::DOUBLE AS "region_INT",
      (dense_rank() OVER (ORDER BY coalesce(competitor_name, '')) - 1)::DOUBLE AS "competitor_name_INT",
      (dense_rank() OVER (ORDER BY dtv_flag) - 1)::DOUBLE AS "dtv_flag_INT" FROM jobs""",
)
def string_index(spark, sf_dir):
    df = filled_jobs(spark, sf_dir)
    fitted = FE.string_indexer(["region", "competitor_name", "dtv_flag"]).fit(df)
    return fitted.transform(df).select("jobid", "region_INT", "competitor_name_INT", "dtv_flag_INT")


ASSEMBLED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("assemble", f"SELECT l_orderkey, {', '.join(f'{c} AS f{i}' for i, c in enumerate(ASSEMBLED))} FROM lineitem")
def assemble(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    vectors = VectorAssembler(inputCols=ASSEMBLED, outputCol="vectorized", handleInvalid="skip").transform(li)
    return flatten_vector(vectors.select("l_orderkey", "vectorized"), "vectorized", len(ASSEMBLED), "f")


@query(
    "impute_mean",
    f"""WITH {JOBS_SQL} SELECT jobid, {r4('coalesce(competitor_price, (SELECT avg(competitor_price) FROM jobs))', 2)} AS price
    FROM jobs""",
)
def impute_mean(spark, sf_dir):
    df = jobs(spark, sf_dir).select("jobid", "competitor_price")
    fitted = Imputer(strategy="mean", inputCols=["competitor_price"], outputCols=["price"]).fit(df)
    return fitted.transform(df).select("jobid", round_half_up("price", 2).alias("price"))


def _vector_columns(template: str, alias: str = "e") -> str:
    return ", ".join(f"{r4(template.format(i=i + 1))} AS {alias}{i}" for i in range(SIZE))


@query(
    "scale_l2",
    f"""SELECT vec_id, {_vector_columns('embedding[{i}]::DOUBLE / norm')} FROM (SELECT *,
      sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS norm FROM embeddings)""",
)
def scale_l2(spark, sf_dir):
    from pyspark.ml.functions import array_to_vector

    df = table(spark, sf_dir, "embeddings").select("vec_id", array_to_vector("embedding").alias("v"))
    scaled = FE.scaler("l2", "v", "e").transform(df).select("vec_id", "e")
    return rounded(flatten_vector(scaled, "e", SIZE), [f"e{i}" for i in range(SIZE)])


def _scaled_lines(spark, sf_dir, kind):
    li = table(spark, sf_dir, "lineitem").withColumn("one", F.lit(1.0))
    names = [*ASSEMBLED, "one"]
    vectors = FE.assembler(names).transform(li).select("l_orderkey", "vectorized")
    scaled = FE.scaler(kind).fit(vectors).transform(vectors).select("l_orderkey", "normalized")
    return rounded(flatten_vector(scaled, "normalized", len(names), "f"), [f"f{i}" for i in range(len(names))])


@query(
    "scale_minmax",
    "WITH s AS (SELECT "
    + ", ".join(f"min({c}) AS lo{i}, max({c}) AS hi{i}" for i, c in enumerate(ASSEMBLED))
    + " FROM lineitem) SELECT l_orderkey, "
    + ", ".join(f"{r4(f'({c} - lo{i}) / (hi{i} - lo{i})')} AS f{i}" for i, c in enumerate(ASSEMBLED))
    + ", CAST(0.5 AS DOUBLE) AS f4 FROM lineitem, s",
)
def scale_minmax(spark, sf_dir):
    return _scaled_lines(spark, sf_dir, "minmax")


@query(
    "scale_std",
    "WITH s AS (SELECT "
    + ", ".join(f"stddev_samp({c}) AS sd{i}" for i, c in enumerate(ASSEMBLED))
    + " FROM lineitem) SELECT l_orderkey, "
    + ", ".join(f"{r4(f'{c} / sd{i}')} AS f{i}" for i, c in enumerate(ASSEMBLED))
    + ", CAST(0 AS DOUBLE) AS f4 FROM lineitem, s",
)
def scale_std(spark, sf_dir):
    return _scaled_lines(spark, sf_dir, "std")


@query(
    "gold_features",
    f"""WITH {JOBS_SQL}, f AS (SELECT jobid, final_response, assignment_start_dt < DATE '{TRAIN_END}' AS is_train,
      dense_rank() OVER (ORDER BY region) - 1 AS f0,
      dense_rank() OVER (ORDER BY coalesce(competitor_name, '')) - 1 AS f1,
      coalesce(competitor_price, 0) AS f2, dense_rank() OVER (ORDER BY dtv_flag) - 1 AS f3 FROM jobs),
    s AS (SELECT stddev_samp(f0) AS s0, stddev_samp(f1) AS s1, stddev_samp(f2) AS s2, stddev_samp(f3) AS s3
      FROM f WHERE is_train)
    SELECT jobid, final_response, {', '.join(f"{r4(f'f{i} / s{i}')} AS f{i}" for i in range(4))} FROM f, s""",
)
def gold_features(spark, sf_dir):
    fitted, df = gold_pipeline(spark, sf_dir)
    gold = fitted.transform(df).select("jobid", "final_response", "normalized")
    return rounded(flatten_vector(gold, "normalized", 4, "f"), [f"f{i}" for i in range(4)])


REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
NAMES = ["-9999", "AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]
FLAGS = ["No", "Unknown", "Yes"]


def _flags_sql(col: str, values: list[str], text: str | None = None) -> list[str]:
    return [f"""coalesce(({text or col} = '{v}')::INTEGER, 0) AS "{col}__{v}\"""" for v in values]


@query(
    "one_hot",
    f"""WITH {JOBS_SQL} SELECT jobid, {', '.join(_flags_sql('region', REGIONS)
      + _flags_sql('competitor_name', NAMES[1:]) + _flags_sql('dtv_flag', FLAGS))} FROM jobs""",
)
def one_hot(spark, sf_dir):
    df = jobs(spark, sf_dir).select("jobid", "region", "competitor_name", "dtv_flag")
    return FE.one_hot(df, FE.categories(df, ["region", "competitor_name", "dtv_flag"]))


DATE_PARTS = {
    "DayOfWeek": "isodow(d) - 1",
    "DayOfMonth": "day(d)",
    "DayOfYear": "dayofyear(d)",
    "WeekOfYear": "weekofyear(d)",
    "MonthOfYear": "month(d)",
}


@query(
    "auto_features",
    f"""WITH {JOBS_SQL}, t AS (SELECT *, assignment_start_dt AS d FROM jobs WHERE assignment_start_dt >= DATE '{TRAIN_END}')
    SELECT jobid, final_response, coalesce(competitor_price, -9999) AS competitor_price,
      {', '.join(f'cast({e} AS INTEGER) AS "assignment_start_dt_{n}"' for n, e in DATE_PARTS.items())},
      {', '.join(_flags_sql('region', REGIONS) + _flags_sql('competitor_name', NAMES, "coalesce(competitor_name, '-9999')")
      + _flags_sql('dtv_flag', FLAGS))} FROM t""",
)
def auto_features(spark, sf_dir):
    """Fitted on the training rows, applied to the test rows."""
    df = jobs(spark, sf_dir)
    config = FE.TrainingSet(
        "jobid", "final_response", "regression", date_field="assignment_start_dt", drop=("assignment_start_month", "unknown")
    )
    fitted = FE.AutoFeatures(config).fit(df.filter(is_train()))
    return fitted.transform(df.filter(~is_train()))


@query(
    "one_hot_sparse",
    """WITH rows AS (SELECT o_orderkey, o_custkey::VARCHAR AS customer, o_orderpriority, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status FROM orders),
      a AS (SELECT customer, row_number() OVER (ORDER BY customer) - 1 AS at FROM (SELECT DISTINCT customer FROM rows)),
      b AS (SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) - 1 AS at FROM (SELECT DISTINCT o_orderpriority FROM rows)),
      c AS (SELECT status, row_number() OVER (ORDER BY status) - 1 AS at FROM (SELECT DISTINCT status FROM rows WHERE status IS NOT NULL)),
      w AS (SELECT (SELECT count(*) FROM a) AS na, (SELECT count(*) FROM b) AS nb, (SELECT count(*) FROM c) AS nc)
    SELECT o_orderkey, na + nb + nc AS width, concat_ws(',', a.at, na + b.at, na + nb + c.at) AS ones
    FROM rows JOIN a USING (customer) JOIN b USING (o_orderpriority) LEFT JOIN c USING (status), w""",
)
def one_hot_sparse(spark, sf_dir):
    """One indicator per customer, priority and status; a missing status has none."""
    orders = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    rows = orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"), "o_orderpriority", status.alias("status"))
    fitted = encoding.fit_categories(rows, ["customer", "o_orderpriority", "status"])
    encoded = encoding.one_hot_sparse(rows, fitted)
    return encoded.select("o_orderkey", F.lit(fitted.width).cast("long").alias("width"), F.array_join("indices", ",").alias("ones"))
