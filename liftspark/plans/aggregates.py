"""Aggregates, crosstabs, quantiles, top-k and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from liftspark.functions.columns import round_half_up
from liftspark.operators import profile as P
from liftspark.plans.registry import query
from liftspark.plans.tables import JOBS_SQL, LIFT_INPUT_SQL, jobs, lift_input, r4, table, tagged_orders

PROBS = (0.0, 0.25, 0.5, 0.75, 1.0)
BINS = 30
RECENT_COLUMNS = ["jobid", "region", "assignment_start_dt", "competitor_name", "competitor_price"]


@query(
    "price_range_by_region",
    f"WITH {JOBS_SQL} SELECT region, min(competitor_price) AS min, max(competitor_price) AS max FROM jobs GROUP BY region",
)
def price_range_by_region(spark, sf_dir):
    return P.value_range(jobs(spark, sf_dir), "competitor_price", ["region"])


@query(
    "price_stats_by_competitor",
    f"""WITH {JOBS_SQL} SELECT region, competitor_name, min(competitor_price) AS min, max(competitor_price) AS max,
      {r4('avg(competitor_price)', 2)} AS average
    FROM jobs WHERE competitor_name IS NOT NULL GROUP BY ALL ORDER BY competitor_name, region""",
)
def price_stats_by_competitor(spark, sf_dir):
    keys = ["region", "competitor_name"]
    stats = P.value_stats(jobs(spark, sf_dir), "competitor_price", keys, required=["competitor_name"])
    return stats.withColumn("average", round_half_up("average", 2)).orderBy("competitor_name", "region")


@query(
    "count_by_month",
    f"""WITH {JOBS_SQL} SELECT assignment_start_month, count(assignment_start_month) AS n FROM jobs
    GROUP BY assignment_start_month ORDER BY assignment_start_month""",
)
def count_by_month(spark, sf_dir):
    month = "assignment_start_month"
    return jobs(spark, sf_dir).groupBy(month).agg(F.count(month).alias("n")).orderBy(month)


def _crosstab_sql(row: str) -> str:
    return f"""WITH {JOBS_SQL} SELECT {row}, count(*) FILTER (final_response = 0) AS "0",
      count(*) FILTER (final_response = 1) AS "1" FROM jobs GROUP BY {row}"""


@query("crosstab_label_region", _crosstab_sql("region"))
def crosstab_label_region(spark, sf_dir):
    return P.crosstab(jobs(spark, sf_dir), "region", "final_response", [0, 1])


@query("crosstab_label_month", _crosstab_sql("assignment_start_month"))
def crosstab_label_month(spark, sf_dir):
    return P.crosstab(jobs(spark, sf_dir), "assignment_start_month", "final_response", [0, 1])


@query("class_counts", f"WITH {JOBS_SQL} SELECT final_response, count(final_response) AS count FROM jobs GROUP BY 1")
def class_counts(spark, sf_dir):
    return P.class_counts(jobs(spark, sf_dir), "final_response")


@query(
    "class_fractions",
    f"""WITH {JOBS_SQL}, c AS (SELECT final_response, count(*) AS count FROM jobs GROUP BY 1)
    SELECT final_response, count, {r4('least(min(count) OVER () * CAST(2.0 AS DOUBLE), count) / count', 6)} AS fraction FROM c""",
)
def class_fractions(spark, sf_dir):
    found = P.class_fractions(jobs(spark, sf_dir), "final_response", max_imbalance=2.0)
    return found.withColumn("fraction", round_half_up("fraction", 6))


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def row_count(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count("*").alias("n"))


@query(
    "quantiles",
    "SELECT prob, "
    + r4("quantile")
    + """ AS quantile FROM (SELECT unnest([0.0, 0.25, 0.5, 0.75, 1.0])::DOUBLE AS prob,
      unnest(quantile_cont(l_extendedprice, [0.0, 0.25, 0.5, 0.75, 1.0])) AS quantile FROM lineitem)""",
)
def quantiles(spark, sf_dir):
    found = P.quantiles(table(spark, sf_dir, "lineitem"), "l_extendedprice", PROBS)
    return found.withColumn("quantile", round_half_up("quantile"))


@query(
    "quantiles_by_type",
    "SELECT event_type, prob, "
    + r4("quantile")
    + """ AS quantile FROM (SELECT event_type, unnest([0.0, 0.25, 0.5, 0.75, 1.0])::DOUBLE AS prob,
      unnest(quantile_cont(value, [0.0, 0.25, 0.5, 0.75, 1.0])) AS quantile FROM events GROUP BY event_type)""",
)
def quantiles_by_type(spark, sf_dir):
    found = P.quantiles(table(spark, sf_dir, "events"), "value", PROBS, keys=["event_type"])
    return found.withColumn("quantile", round_half_up("quantile"))


@query(
    "histogram30",
    f"""WITH r AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
    c AS (SELECT least(floor((value - lo) * CAST(30 AS DOUBLE) / (hi - lo)), 29)::INTEGER AS bin, count(*) AS n
      FROM events, r GROUP BY 1)
    SELECT b.bin::INTEGER AS bin, {r4('lo + b.bin * ((hi - lo) / 30)')} AS lower,
      {r4('lo + (b.bin + 1) * ((hi - lo) / 30)')} AS upper, coalesce(n, 0) AS n
    FROM (SELECT unnest(range(30)) AS bin) b CROSS JOIN r LEFT JOIN c ON b.bin = c.bin""",
)
def histogram30(spark, sf_dir):
    found = P.histogram(table(spark, sf_dir, "events"), "value", BINS)
    return found.withColumns({"lower": round_half_up("lower"), "upper": round_half_up("upper")})


@query(
    "distinct_tags",
    f"""WITH {LIFT_INPUT_SQL}
    SELECT DISTINCT 'tag' AS name, tag AS value FROM lift_input
    UNION ALL SELECT DISTINCT 'test_type', test_type FROM lift_input
    UNION ALL SELECT DISTINCT 'capture_type', capture_type FROM lift_input
    UNION ALL SELECT DISTINCT 'prod_type', prod_type FROM lift_input ORDER BY name, value""",
)
def distinct_tags(spark, sf_dir):
    return P.distinct_tags(lift_input(tagged_orders(spark, sf_dir)), ["tag", "test_type", "capture_type", "prod_type"])


@query(
    "recent_1000",
    f"""WITH {JOBS_SQL} SELECT {', '.join(RECENT_COLUMNS)} FROM jobs
    ORDER BY assignment_start_dt DESC, jobid LIMIT 1000""",
)
def recent_1000(spark, sf_dir):
    recent = jobs(spark, sf_dir).select(RECENT_COLUMNS)
    return recent.orderBy(F.col("assignment_start_dt").desc(), "jobid").limit(1000)


@query(
    "top_of_recent",
    f"""WITH {JOBS_SQL}, recent AS (SELECT {', '.join(RECENT_COLUMNS)} FROM jobs
      ORDER BY assignment_start_dt DESC, jobid LIMIT 1000)
    SELECT * FROM recent ORDER BY competitor_price DESC NULLS LAST, jobid LIMIT 10""",
)
def top_of_recent(spark, sf_dir):
    dearest = F.col("competitor_price").desc_nulls_last()
    return recent_1000(spark, sf_dir).orderBy(dearest, "jobid").limit(10)
