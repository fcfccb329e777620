"""Sparse one-hot vectors of many categories; snapshots under several publishers."""

import random
import threading
import time

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from liftspark.operators import encoding as E
from liftspark.sources import snapshots as S


def test_sparse_against_dense(spark, monkeypatch):
    r = random.Random(3)
    pick = lambda n: r.choice([None, *(f"v{i}" for i in range(n)), "é", "", "Z"])
    rows = [(i, pick(9), pick(30), r.randint(1, 4), r.random()) for i in range(300)]
    schema = "id int, a string, `b.c` string, n int, x double"
    df = spark.createDataFrame(rows, schema).repartition(3)
    train = df.filter("id < 200")
    known = [sorted({str(row[c]) for row in rows[:200] if row[c] is not None}, key=lambda v: v.encode()) for c in (1, 2, 3)]
    for limit in (E.BROADCAST_ROWS, 0):
        monkeypatch.setattr(E, "BROADCAST_ROWS", limit)
        fitted = E.fit_categories(train, ["a", "b.c", "n"])
        assert [fitted.counts[c] for c in fitted.columns] == list(map(len, known))
        got = {x.id: x for x in E.one_hot_sparse(df, fitted).collect()}
        assert set(got[0].asDict()) == {"id", "x", "indices"} and len(got) == 300
        starts = [0, len(known[0]), len(known[0]) + len(known[1])]
        want = {row[0]: [s + k.index(str(v)) for s, k, v in zip(starts, known, row[1:4]) if v is not None and str(v) in k] for row in rows}
        assert {i: x.indices for i, x in got.items()} == want
    vectors = E.sparse_features(df.withColumnRenamed("b.c", "b"), E.fit_categories(train.withColumnRenamed("b.c", "b"), ["a", "b", "n"]), ["x"])
    assert vectors.columns == ["id", "a", "b", "n", "x", "features"]
    for x in vectors.collect():
        assert x.features.size == 1 + sum(map(len, known))
        assert sorted(i for i, v in zip(x.features.indices.tolist(), x.features.values.tolist()) if i and v) == [1 + i for i in want[x.id]]
    assert vectors.select(F.size(vector_to_array("features"))).distinct().count() == 1


def test_two_hundred_thousand_categories(spark):
    rows = spark.range(0, 400_000, 1, 8).select(F.concat(F.lit("c"), F.col("id") % 200_000).alias("c"), F.lit("same").alias("d"), "id")
    fitted = E.fit_categories(rows, ["c", "d"])
    assert fitted.counts == {"c": 200_000, "d": 1}
    encoded = E.one_hot_sparse(rows, fitted)
    assert encoded.agg(F.count_distinct(F.col("indices")[0]), F.min(F.col("indices")[1]), F.max(F.size("indices"))).first()[:] == (200_000, 200_000, 2)


def test_nothing_to_encode(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, c string")
    fitted = E.fit_categories(df, ["c"])
    assert fitted.width == 0 and [r.indices for r in E.one_hot_sparse(df, fitted).collect()] == [[], []]
    assert all(r.features.numNonzeros() <= 1 for r in E.sparse_features(df, fitted, ["id"]).collect())
    assert E.fit_categories(df.limit(0), ["c"]).width == 0


def test_publishers_that_meet(spark, tmp_path):
    """Two publishers stage their files, then both commit: both versions stand, in order, the second upon the first."""
    path = str(tmp_path / "t")
    base = S.publish_snapshot(spark.range(1), path, expected=None)
    one, two = S.stage_snapshot(spark.range(2), path), S.stage_snapshot(spark.range(3), path)
    second = S.commit(spark, path, "main", two)
    first = S.commit(spark, path, "main", one)
    assert (base, second, first) == (1, 2, 3)
    rows = [(r.version, r.parent, r.operation) for r in S.history(spark, path).orderBy("version").collect()]
    assert rows == [(1, None, "replace"), (2, 1, "replace"), (3, 2, "replace")]
    assert [S.read_snapshot(spark, path, version=v).count() for v in (1, 2, 3)] == [1, 3, 2]
    with pytest.raises(S.CommitConflict):
        S.publish_snapshot(spark.range(9), path, expected=2)
    with pytest.raises(S.CommitConflict):
        S.publish_snapshot(spark.range(9), path, expected=None)
    assert S.publish_snapshot(spark.range(9), path, expected=3) == 4


def test_many_publishers_at_once(spark, tmp_path):
    path, got = str(tmp_path / "t"), []
    folder = S.stage_snapshot(spark.range(1), path)
    threads = [threading.Thread(target=lambda: [got.append(S.commit(spark, path, "main", folder)) for _ in range(5)]) for _ in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got) == list(range(1, 31))
    parents = [r.parent for r in S.history(spark, path).orderBy("version").collect()]
    assert all(p is None or p < v for v, p in enumerate(parents, 1))


def test_torn_manifests_and_time(spark, tmp_path):
    path = str(tmp_path / "t")
    S.publish_snapshot(spark.range(1), path)
    between = time.time_ns()
    with open(f"{path}/manifest/branch=main/000000000002.json", "w") as out:
        out.write('{"version": 2, "par')
    assert S.latest_version(spark, path) == 1 and S.read_snapshot(spark, path).count() == 1
    assert S.publish_snapshot(spark.range(5), path, expected=1) == 3
    assert S.read_snapshot(spark, path).count() == 5
    assert S.read_snapshot(spark, path, published_by=between).count() == 1
    for wrong in ({"version": 2}, {"version": 7}, {"published_by": 5}, {"branch": "none"}):
        with pytest.raises(ValueError):
            S.read_snapshot(spark, path, **wrong)


def test_expiry(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(4):
        S.publish_snapshot(spark.range(n), path)
    shared = S.history(spark, path).filter("version = 1").first()["folder"]
    S.commit(spark, path, "main", shared, "rollback")
    assert S.expire(spark, path, keep=2) == []  # too young
    assert S.expire(spark, path, keep=2, older_than_seconds=0) == [1, 2, 3]
    assert S.read_snapshot(spark, path).count() == 0  # the files of the first version, which the last still names
    assert S.read_snapshot(spark, path, version=4).count() == 3
    assert S.publish_snapshot(spark.range(2), path) == 6
    assert S.expire(spark, path, keep=0, older_than_seconds=0) == [4, 5]
