"""Sources, sinks and catalogue queries."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from liftspark.functions.columns import round_half_up
from liftspark.operators.features import feature_pipeline
from liftspark.operators.profile import value_range
from liftspark.plans.registry import query
from liftspark.plans.tables import JOBS_SQL, jobs, r4, table
from liftspark.session import scratch_path
from liftspark.sources import catalog, readers, snapshots, writers
from liftspark.sources import checked as readers_checked

JOB_COLUMNS = "jobid, region, assignment_start_dt, competitor_name, competitor_price, dtv_flag, final_response"
JOB_SCHEMA = (
    "jobid bigint, region string, assignment_start_dt date, assignment_start_month date, "
    "competitor_name string, competitor_price double, dtv_flag string, final_response int"
)
PRICE_SCHEMA = "region string, min double, max double"
PRICE_SQL = f"""WITH {JOBS_SQL}
SELECT region, min(competitor_price) AS min, max(competitor_price) AS max FROM jobs GROUP BY region"""


@query("scan_csv_inferred", f"WITH {JOBS_SQL} SELECT {JOB_COLUMNS} FROM jobs")
def scan_csv_inferred(spark, sf_dir):
    path = scratch_path(spark, "tsv")
    jobs(spark, sf_dir).write.option("sep", "\t").option("header", True).option("nullValue", "NULL").csv(path)
    found = readers.read_delimited(spark, path)
    return found.selectExpr(
        "cast(jobid as bigint) as jobid",
        "region",
        "assignment_start_dt",
        "competitor_name",
        "competitor_price",
        "dtv_flag",
        "final_response",
    )


CHECKED_COLUMNS = ["jobid", "region", "price", "start", "flag"]


def _faulty(spark, sf_dir):
    """Jobs as text, of which some have a word for a price, two fields only, or a word for a date."""
    path, turn = scratch_path(spark, "faulty"), F.col("jobid") % 40
    rows = jobs(spark, sf_dir).select(
        F.col("jobid").cast("string"),
        "region",
        F.when(turn == 0, F.lit("n/a")).otherwise(F.col("competitor_price").cast("string")).alias("price"),
        F.when(turn == 2, F.lit("soon")).otherwise(F.col("assignment_start_dt").cast("string")).alias("start"),
        (F.col("final_response") == 1).cast("string").alias("flag"),
        turn.alias("turn"),
    )
    rows.filter("turn <> 1").drop("turn").write.csv(path, header=True)
    rows.filter("turn = 1").select("jobid", "region").write.mode("append").csv(path, header=True)
    return readers_checked.read_checked(spark, path, CHECKED_COLUMNS)


@query(
    "scan_csv_checked",
    f"""WITH {JOBS_SQL} SELECT jobid, region, competitor_price AS price, assignment_start_dt AS start, final_response = 1 AS flag
      FROM jobs WHERE jobid % 40 > 2""",
)
def scan_csv_checked(spark, sf_dir):
    """The lines that fit the inferred types, typed."""
    return _faulty(spark, sf_dir).rows


@query(
    "scan_csv_rejects",
    f"""WITH {JOBS_SQL} SELECT CASE jobid % 40 WHEN 0 THEN 'price is no double' WHEN 1 THEN 'number of fields' WHEN 2 THEN 'start is no date' ELSE 'none' END AS reason,
      count(*) AS n, sum(jobid)::BIGINT AS ids FROM jobs GROUP BY 1""",
)
def scan_csv_rejects(spark, sf_dir):
    """Rows and rejects are all lines."""
    found = _faulty(spark, sf_dir)
    ids = F.substring_index("line", ",", 1).cast("bigint").alias("jobid")
    every = found.rejects.select("reason", ids).union(found.rows.select(F.lit("none"), "jobid"))
    return every.groupBy("reason").agg(F.count("*").alias("n"), F.sum("jobid").alias("ids"))


@query("scan_csv_strings", "SELECT cast(o_orderkey AS varchar) AS o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def scan_csv_strings(spark, sf_dir):
    path = scratch_path(spark, "csv")
    table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority").write.option(
        "header", True
    ).csv(path)
    return readers.read_csv_strings(spark, path)


@query("scan_table", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def scan_table(spark, sf_dir):
    return readers.read_table(spark, f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity")


@query("scan_parquet_glob", f"WITH {JOBS_SQL} SELECT jobid, region, dtv_flag FROM jobs WHERE region LIKE 'A%'")
def scan_parquet_glob(spark, sf_dir):
    path = scratch_path(spark, "by-region")
    writers.write_partitioned(jobs(spark, sf_dir), path, "region")
    return readers.read_table(spark, f"{path}/region=A*", base_path=path).select("jobid", "region", "dtv_flag")


@query("scan_fallback", "SELECT o_orderkey, o_orderstatus FROM orders")
def scan_fallback(spark, sf_dir):
    absent = scratch_path(spark, "absent")
    found = readers.read_first_existing(spark, [absent, f"{sf_dir}/orders.parquet"])
    return found.select("o_orderkey", "o_orderstatus")


@query("write_overwrite", f"WITH {JOBS_SQL} SELECT jobid, region, final_response FROM jobs")
def write_overwrite(spark, sf_dir):
    path = scratch_path(spark, "overwrite")
    df = jobs(spark, sf_dir).select("jobid", "region", "final_response")
    writers.write_table(df.withColumn("final_response", F.lit(-1)), path)
    writers.write_table(df, path)
    return readers.read_table(spark, path)


@query("write_partitioned", f"WITH {JOBS_SQL} SELECT jobid, region, assignment_start_month FROM jobs")
def write_partitioned(spark, sf_dir):
    path = scratch_path(spark, "by-month")
    df = jobs(spark, sf_dir).select("jobid", "region", "assignment_start_month")
    writers.write_partitioned(df, path, "assignment_start_month")
    return readers.read_table(spark, path).select("jobid", "region", "assignment_start_month")


@query("partition_layout")
def partition_layout(spark, sf_dir):
    path = scratch_path(spark, "layout")
    writers.write_partitioned(jobs(spark, sf_dir), path, "region")
    return readers.file_layout(spark, path, "region")


@query("partition_rows", f"WITH {JOBS_SQL} SELECT region, count(*) AS n, true AS has_files FROM jobs GROUP BY 1")
def partition_rows(spark, sf_dir):
    """What the layout audit sees of a partitioned table: every partition has files, and holds its rows."""
    path = scratch_path(spark, "layout")
    writers.write_partitioned(jobs(spark, sf_dir), path, "region")
    layout = readers.file_layout(spark, path, "region")
    files = layout.select(F.col("region").alias("r"), (F.col("n_files") > 0).alias("has_files"))
    rows = readers.read_table(spark, path).groupBy("region").agg(F.count("*").alias("n"))
    return rows.join(files, F.col("region") == F.col("r"), "left").select("region", "n", F.coalesce("has_files", F.lit(False)).alias("has_files"))


@query("export_single_csv", PRICE_SQL)
def export_single_csv(spark, sf_dir):
    path = scratch_path(spark, "report") + ".csv"
    writers.export_single_csv(value_range(jobs(spark, sf_dir), "competitor_price", ["region"]), path)
    return readers.read_delimited(spark, path, schema=PRICE_SCHEMA, sep=",")


@query("export_json_records", PRICE_SQL)
def export_json_records(spark, sf_dir):
    path = scratch_path(spark, "records")
    report = value_range(jobs(spark, sf_dir), "competitor_price", ["region"])
    text = spark.createDataFrame([(writers.json_records(report),)], "value string")
    writers.write_table(text, path, fmt="text")
    return spark.read.schema(PRICE_SCHEMA).json(path)


@query(
    "range_count",
    """SELECT (SELECT count(*) FROM range((SELECT max(o_orderkey) + 1 FROM orders))) AS n_generated,
      (SELECT count(DISTINCT o_orderkey) FROM orders) AS n_used""",
)
def range_count(spark, sf_dir):
    keys = table(spark, sf_dir, "orders").select("o_orderkey").distinct()
    n = readers.count_range(spark, keys.agg(F.max("o_orderkey") + 1).first()[0])
    used = spark.range(n).join(keys, F.col("id") == F.col("o_orderkey"), "left_semi")
    return used.agg(F.lit(n).cast("bigint").alias("n_generated"), F.count("*").alias("n_used"))


@query(
    "sql_view",
    f"WITH {JOBS_SQL} SELECT region, dtv_flag, count(*) AS n, sum(final_response)::BIGINT AS responders FROM jobs GROUP BY ALL",
)
def sql_view(spark, sf_dir):
    return catalog.query_view(
        jobs(spark, sf_dir),
        "SELECT region, dtv_flag, count(*) AS n, sum(final_response) AS responders FROM {view} GROUP BY ALL",
    )


@query("sql_select_limit", f"WITH {JOBS_SQL} SELECT {JOB_COLUMNS} FROM jobs ORDER BY jobid LIMIT 10")
def sql_select_limit(spark, sf_dir):
    return catalog.query_view(jobs(spark, sf_dir), f"SELECT {JOB_COLUMNS} FROM {{view}} ORDER BY jobid LIMIT 10")


@query("catalog_tables", f"WITH {JOBS_SQL} SELECT 'jobs_bronze' AS table_name, count(*) AS n_rows FROM jobs")
def catalog_tables(spark, sf_dir):
    path = scratch_path(spark, "bronze")
    writers.write_table(jobs(spark, sf_dir), path)
    own = f"jobs_bronze_{uuid.uuid4().hex}"  # no table of the caller's is touched
    catalog.create_external_table(spark, own, path)
    try:
        (name,) = [r["tableName"] for r in catalog.tables_like(spark, own).collect()]
        out = spark.table(name).agg(F.lit(name[: len("jobs_bronze")]).alias("table_name"), F.count("*").alias("n_rows"))
    finally:
        catalog.drop_table(spark, own)
    return out


@query("snapshot_publish", f"WITH {JOBS_SQL} SELECT jobid, region, competitor_price FROM jobs WHERE final_response = 1")
def snapshot_publish(spark, sf_dir):
    path = scratch_path(spark, "snapshots")
    df = jobs(spark, sf_dir)
    snapshots.publish_snapshot(df.select("jobid", "region", "competitor_price"), path)
    responders = df.filter("final_response = 1").select("jobid", "region", "competitor_price")
    snapshots.publish_snapshot(responders, path)
    return snapshots.read_snapshot(spark, path)


def _three_versions(spark, sf_dir):
    """Jobs of one region, then of all, then responders only, each upon the last; the second by a publisher who lost a number to another."""
    path, df = scratch_path(spark, "snapshots"), jobs(spark, sf_dir).select("jobid", "region", "competitor_price", "final_response")
    first = snapshots.publish_snapshot(df.filter("region = 'ASIA'"), path, expected=None)
    late = snapshots.stage_snapshot(df.filter("final_response = 1"), path)
    second = snapshots.publish_snapshot(df, path, expected=first)
    try:
        snapshots.commit(spark, path, "main", late, expected=first)
    except snapshots.CommitConflict:
        snapshots.commit(spark, path, "main", late, "append", expected=second)
    return path


@query(
    "snapshot_history",
    f"""WITH {JOBS_SQL} SELECT 1::BIGINT AS version, NULL::BIGINT AS parent, 'replace' AS operation, count(*) AS n FROM jobs WHERE region = 'ASIA'
      UNION ALL SELECT 2, 1, 'replace', count(*) FROM jobs UNION ALL SELECT 3, 2, 'append', count(*) FROM jobs WHERE final_response = 1""",
)
def snapshot_history(spark, sf_dir):
    """The versions of a table that two publishers wrote, with the rows that each holds."""
    path = _three_versions(spark, sf_dir)
    counts = [(v, snapshots.read_snapshot(spark, path, version=v).count()) for v in (1, 2, 3)]
    known = snapshots.history(spark, path).select("version", "parent", "operation")
    return known.join(spark.createDataFrame(counts, "version bigint, n bigint"), "version")


@query("snapshot_as_of", f"WITH {JOBS_SQL} SELECT jobid, region, competitor_price, final_response FROM jobs WHERE region = 'ASIA'")
def snapshot_as_of(spark, sf_dir):
    """The rows as they were at the first version."""
    return snapshots.read_snapshot(spark, _three_versions(spark, sf_dir), version=1)


@query("model_roundtrip", "SELECT count(*) AS n_rows, cast(0 AS BIGINT) AS n_changed FROM orders")
def model_roundtrip(spark, sf_dir):
    """A saved feature pipeline transforms every row as it did before."""
    df = jobs(spark, sf_dir).fillna({"competitor_name": "", "competitor_price": 0.0})
    exclude = ["jobid", "final_response", "assignment_start_dt", "assignment_start_month"]
    fitted = feature_pipeline(df, exclude).fit(df)
    path = scratch_path(spark, "pipeline")
    fitted.write().overwrite().save(path)
    loaded = readers.load_pipeline(spark, [scratch_path(spark, "absent"), path])
    assert isinstance(loaded, PipelineModel)
    before = fitted.transform(df).select("jobid", F.col("normalized").alias("before"))
    after = loaded.transform(df).select("jobid", F.col("normalized").alias("after"))
    both = before.join(after, "jobid")
    changed = F.col("before").cast("string") != F.col("after").cast("string")
    return both.agg(F.count("*").alias("n_rows"), F.count_if(changed).alias("n_changed"))


@query(
    "pandas_api_stats",
    f"""WITH {JOBS_SQL} SELECT region, competitor_name AS competitor, min(competitor_price) AS min,
      max(competitor_price) AS max, {r4('avg(competitor_price)', 2)} AS avg
    FROM jobs WHERE competitor_name IS NOT NULL GROUP BY ALL""",
)
def pandas_api_stats(spark, sf_dir):
    import pyspark.pandas as ps

    frame = jobs(spark, sf_dir).select("region", "competitor_name", "competitor_price")
    # the default index numbers all rows in sequence; nothing here needs that
    with ps.option_context("compute.default_index_type", "distributed"):
        grouped = (
            frame.pandas_api()
            .groupby(["region", "competitor_name"])
            .agg({"competitor_price": ["min", "max", "mean"]})
            .reset_index()
        )
        grouped.columns = ["region", "competitor", "min", "max", "avg"]
        out = grouped.dropna(subset=["competitor"]).sort_values(["competitor"]).to_spark()
    return out.withColumn("avg", round_half_up("avg", 2))
