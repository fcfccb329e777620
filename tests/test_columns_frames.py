import datetime as dt

import duckdb
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

import __spark_entry__ as entry
from liftspark.functions import columns as C
from liftspark.functions import frames as FR
from liftspark.functions.hashing import hash_bucket
from tests.oracle import compare


def test_rounding(spark):
    df = spark.createDataFrame([(0.00005,), (1.23455,), (-0.5,), (None,)], "v double")
    assert [r[0] for r in df.select(C.round_half_up("v")).collect()] == [0.0001, 1.2346, -0.5, None]
    assert [r[0] for r in C.rounded(df, ["v"]).collect()] == [0.0001, 1.2346, -0.5, None]


def test_date_parts(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 3),)], "d date")
    assert tuple(C.date_parts(df, "d").first()) == (6, 3, 3, 53, 1)
    assert "d" in C.date_parts(df, "d", keep=True).columns


def test_lift_tags(spark):
    df = spark.createDataFrame([("train_top_sales_mob",), ("test1_top_value",)], "k string")
    got = [tuple(r)[1:] for r in C.with_lift_tags(df, "k").collect()]
    assert got == [("train", "sales", "mob"), ("test1", "value", "all")]


def test_group_tag_keeps_later_underscores(spark):
    df = spark.createDataFrame([(0.2, "south_tx")], "g double, tag string")
    joined = df.select(C.group_tag("g", "tag").alias("group_tag"))
    assert joined.first()[0] == "0.2_south_tx"
    assert tuple(C.split_group_tag(joined).first()) == ("0.2", "south_tx")


def test_feature_base_name(spark):
    df = spark.createDataFrame([("age_imputed",), ("region_index",), ("plain",)], "v string")
    assert [r[0] for r in df.select(C.feature_base_name("v")).collect()] == ["age", "region", "plain"]


def test_vectors(spark):
    df = spark.createDataFrame([(1, Vectors.dense(0.25, 0.75)), (2, Vectors.sparse(2, {1: 0.5}))], ["id", "v"])
    assert [r[0] for r in df.select(C.last_probability(df, "v")).collect()] == [0.75, 0.5]
    assert [tuple(r) for r in C.flatten_vector(df, "v", 2).collect()] == [(1, 0.25, 0.75), (2, 0.0, 0.5)]


def test_scrub_prediction(spark):
    df = spark.createDataFrame([(-2.0, 0.5), (3.0, 0.51), (None, None)], "x double, p double")
    scrubbed = df.select(
        C.scrub_prediction("regression", "x"), C.scrub_prediction("classification", "x", "p"), C.scrub_prediction("propensity", "x", "p")
    )
    assert [tuple(r) for r in scrubbed.collect()] == [(0.0, 0, 0.5), (3.0, 1, 0.51), (None, None, None)]
    with pytest.raises(ValueError):
        C.scrub_prediction("other", "x")


def test_cut(spark):
    df = spark.createDataFrame([(float(v),) for v in (-1, 0, 0.5, 777, 777.5, 26035, 26036)] + [(None,)], "v double")
    edges, labels = [0, 777, 2409, 4952, 26035], [1, 2, 3, 4]
    assert [r[0] for r in df.select(C.cut("v", edges, labels)).collect()] == [None, None, 1, 1, 2, 4, None, None]
    lowest = [r[0] for r in df.select(C.cut("v", edges, labels, include_lowest=True)).collect()]
    assert lowest[:2] == [None, 1]
    with pytest.raises(ValueError):
        C.cut("v", [1, 1], [1])


DIRTY = "a double, b int, c bigint, s string, f boolean, d date"


def test_fills(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(nan, None, None, None, None, None), (inf, 1, 2, "x", True, None)], DIRTY)
    assert tuple(FR.fill_by_type(df).first()) == (0.0, 0, 0, "", None, None)
    assert FR.fill_by_type(df, boolean=False).first()["f"] is False
    got = [tuple(r) for r in FR.fill_sentinel(df).collect()]
    assert got == [(-9999.0, -9999, -9999, "-9999", None, None), (-9999.0, 1, 2, "x", True, None)]


def test_schema_profile(spark):
    df = spark.createDataFrame([(1.0, 1, 2, "x", None, None)], DIRTY)
    assert FR.column_classes(df) == {"numeric": ["a", "b", "c", "f"], "string": ["s"], "invalid": ["d"]}
    assert FR.column_classes(df, ["a"], strict=True) == {"numeric": ["b", "f"], "string": ["s"], "invalid": ["c", "d"]}
    got = {r["column_name"]: (r["type"], r["class"], r["n_present"]) for r in FR.schema_profile(df).collect()}
    assert got["f"] == ("boolean", "numeric", 0) and got["c"] == ("bigint", "numeric", 1)


def test_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`a[0]` int, `b<5` int, c int")
    assert FR.sanitize_columns(df).columns == ["a__0__", "b__5", "c"]
    with pytest.raises(ValueError, match="collide"):
        FR.sanitize_columns(df.toDF("x[", "x]", "c"))
    assert FR.drop_tolerant(df.toDF("a", "b", "c"), ["c", "zz", "c"]).columns == ["a", "b"]


def test_sync_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "id int, x int, extra int")
    got = FR.sync_columns(df, ["y", "x", "r__A"], keep=["id", "target"], indicators=["r__A"]).first()
    assert got.asDict() == {"id": 1, "y": -9999, "x": 2, "r__A": 0}


def test_hook(spark):
    df = spark.range(1)
    assert FR.apply_hook(df, None) is df
    assert FR.apply_hook(df, lambda d: d.withColumn("x", F.lit(5))).first()["x"] == 5


def test_hash_bucket(spark):
    df = spark.range(1000)
    for fn in ("murmur3", "md5", "xxhash64"):
        found = {r[0] for r in df.select(hash_bucket("id", 10, fn)).collect()}
        assert found == set(range(10))
    native = df.filter(hash_bucket("id", 3) != F.expr("pmod(hash(id), 3)")).count()
    assert native == 0
    with pytest.raises(ValueError):
        hash_bucket("id", 3, "sha")


def test_fill_by_type_leaves_keys(spark):
    df = spark.createDataFrame([(None, None, None, None)], "k bigint, t string, v double, s string")
    assert tuple(FR.fill_by_type(df, skip=["k", "t"]).first()) == (None, None, 0.0, "")


def test_fill_by_type_query_on_null_keys(spark, tmp_path):
    """The query's SQL fills quantity, line and flag only."""
    rows = [(None, 1, 2.0, "A", "F"), (1, None, 3.0, None, "O"), (2, 3, None, "R", None)]
    schema = "l_orderkey bigint, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    verdict, n = compare(spark, con, entry.queries()["fill_by_type"], entry.oracle_sql()["fill_by_type"], str(tmp_path))
    assert (verdict, n) == ("", 3)
