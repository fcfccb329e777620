import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from liftspark.operators import gain as G
from liftspark.operators.profile import value_stats
from liftspark.plans import registry
from liftspark.plans.tables import jobs
from liftspark.session import checkpointed, scratch_path, scratch_root
from liftspark.sources import catalog, readers, snapshots, writers

registry.load_all()
SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


class Session:
    """As much of a session as the scratch folder asks for."""

    def __init__(self, master, folder=None):
        self.sparkContext = SimpleNamespace(master=master)
        self.conf = SimpleNamespace(get=lambda key, default=None: folder or default)


def test_scratch(spark):
    assert scratch_path(spark, "x").startswith(scratch_root(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(Session("yarn", "hdfs://shared/folder/"), "x").startswith("hdfs://shared/folder/liftspark/x-")
    assert scratch_root(Session("local[2]"))
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:1"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            scratch_root(Session(master))


def test_checkpointed(spark):
    df = spark.range(5).select(F.struct("id", F.lit(None).cast("string").alias("n")).alias("k"), F.lit(True).alias("b"))
    copy = checkpointed(df)
    assert sorted(copy.collect()) == sorted(df.collect()) and copy.dtypes == df.dtypes


def test_delimited(spark, tmp_path):
    path = tmp_path / "t.tsv"
    path.write_text("id\tname\tprice\tday\n1\ta\t2.5\t2021-01-02\n2\tNULL\tNULL\t2021-02-03\n")
    df = readers.read_delimited(spark, str(path))
    assert [t for _, t in df.dtypes] == ["int", "string", "double", "date"]
    assert df.collect()[1]["name"] is None
    given = readers.read_delimited(spark, str(path), schema="id bigint, name string, price double, day string")
    assert given.collect()[0]["day"] == "2021-01-02"


def test_fallback(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "b"))
    assert readers.read_first_existing(spark, [str(tmp_path / "a"), str(tmp_path / "b")]).count() == 3
    assert readers.read_first_existing(spark, [str(tmp_path / "a")]) is None
    assert readers.load_pipeline(spark, [str(tmp_path / "a")]) is None
    assert readers.count_range(spark, 7) == 7


def test_partitioned_write_prunes(spark, tmp_path):
    df = spark.range(100).withColumn("m", F.when(F.col("id") < 90, 0).otherwise(F.col("id") % 5))
    path = str(tmp_path / "p")
    writers.write_partitioned(df, path, "m", max_records_per_file=20)
    back = readers.read_table(spark, path)
    assert back.count() == 100
    assert "PartitionFilters: [isnotnull(m#" in plan(back.filter("m = 3"))
    layout = {r["m"]: r for r in readers.file_layout(spark, path, "m").collect()}
    assert layout[0]["n_files"] >= 5 and layout[3]["n_files"] == 1 and layout[3]["n_bytes"] > 0


def test_error_if_exists(spark, tmp_path):
    path = str(tmp_path / "e")
    writers.write_table(spark.range(3), path, mode="errorifexists")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writers.write_table(spark.range(3), path, mode="errorifexists")
    writers.write_table(spark.range(1), path)
    assert readers.read_table(spark, path).count() == 1


def test_single_csv(spark, tmp_path):
    path = tmp_path / "r.csv"
    for n in (3, 2):  # the second replaces the first
        writers.export_single_csv(spark.range(n), str(path))
        assert path.is_file() and len(path.read_text().splitlines()) == n + 1
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["r.csv"]


def test_json_records(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert json.loads(writers.json_records(df)) == [{"a": 1, "b": None}, {"a": 2, "b": "x"}]
    assert json.loads(writers.json_records(spark.range(0))) == []
    with pytest.raises(ValueError, match="characters"):
        writers.json_records(spark.range(1000), limit=2000)


def test_json_files(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    writers.write_json_records(df, str(tmp_path / "j"))
    lines = [json.loads(line) for f in (tmp_path / "j").glob("part-*.json") for line in f.read_text().splitlines()]
    assert sorted(lines, key=lambda r: r["a"]) == [{"a": 1, "b": None}, {"a": 2, "b": "x"}]


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "s")
    first = snapshots.publish_snapshot(spark.range(3), path)
    snapshots.publish_snapshot(spark.range(5), path)
    snapshots.publish_snapshot(spark.range(9), path, branch="other")
    # a version that was written but never published
    spark.range(99).write.parquet(f"{path}/branch=main/version=zzz")
    assert snapshots.read_snapshot(spark, path).count() == 5
    assert snapshots.read_snapshot(spark, path, version=first).count() == 3
    assert snapshots.read_snapshot(spark, path, branch="other").count() == 9
    with pytest.raises(ValueError):
        snapshots.read_snapshot(spark, path, branch="none")


def test_views(spark):
    got = catalog.query_view(spark.range(4), "SELECT max(id) AS m FROM {view}")
    assert got.first()["m"] == 3
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("view_")]


def test_filters_reach_the_scan(spark):
    text = plan(jobs(spark, SF).filter(F.col("region") == "ASIA").select("jobid", "region"))
    assert "EqualTo(r_name,ASIA)" in text and "o_orderpriority" not in text
    stats = value_stats(jobs(spark, SF), "competitor_price", ["region", "competitor_name"], ["competitor_name"])
    text = plan(stats)
    assert text.count("HashAggregate") == 2 and "MACHINERY" in text.split("HashAggregate")[-1]


def test_ranking_plans(spark):
    """Rows are never gathered in one partition and never pass through Python, however few there are."""
    rows = registry.QUERIES["global_rank"](spark, SF)
    text = plan(rows)
    assert "Python" not in text
    single = text.split("SinglePartition")
    # the only single partition holds the totals per cell, already aggregated
    assert len(single) == 2 and "HashAggregate" in single[1].splitlines()[1]
    text = plan(G.gain_table(spark.read.parquet(f"{SF}/orders.parquet").selectExpr("o_orderkey AS jobid", "o_totalprice AS score", "int(o_orderkey % 4 = 0) AS final_response")))
    assert "Python" not in text and "LeftSemi" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


def test_registry():
    with pytest.raises(ValueError):
        registry.query("gain_table")(lambda spark, sf_dir: None)
    assert set(registry.ORACLES) <= set(registry.QUERIES)
