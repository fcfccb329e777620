import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from liftspark.operators import features as FE
from liftspark.operators import profile as P
from liftspark.operators import sampling as S


def test_hash_sample_and_split(spark):
    df = spark.range(5000)
    ids = {r["id"] for r in S.hash_sample(df, "id", 0.11).collect()}
    assert ids == {r["id"] for r in S.hash_sample(df.repartition(7), "id", 0.11).collect()}
    assert 400 < len(ids) < 700
    assert S.hash_sample(df, "id", 0.0).count() == 0 and S.hash_sample(df, "id", 1.0).count() == 5000
    parts = S.hash_split(df, "id", [0.9, 0.1])
    assert sum(p.count() for p in parts) == 5000 and parts[0].join(parts[1], "id").count() == 0


def test_stratified(spark):
    df = spark.range(4000).withColumn("c", F.when(F.col("id") % 4 == 0, None).otherwise(F.col("id") % 4))
    got = S.stratified_sample(df, "c", "id", {1: 1.0, 2: 0.0, 3: 0.25})
    counts = {r["c"]: r["count"] for r in got.groupBy("c").count().collect()}
    assert counts[1] == 1000 and 180 < counts[3] < 330 and set(counts) == {1, 3}
    assert S.stratified_sample(df, "c", "id", {None: 1.0}).count() == 1000
    shares = spark.createDataFrame([(1, 1.0), (None, 0.5)], "c long, fraction double")
    by_table = {r["c"]: r["count"] for r in S.stratified_sample(df, "c", "id", shares).groupBy("c").count().collect()}
    assert set(by_table) == {1, None} and by_table[1] == 1000 and 400 < by_table[None] < 600
    assert S.stratified_sample(df, "c", "id", {1: 1.0}, overall=0.5).count() == pytest.approx(500, abs=80)


def test_balanced(spark):
    df = spark.range(2200).withColumn("y", (F.col("id") < 200).cast("int"))
    fractions = {r["y"]: r["fraction"] for r in P.class_fractions(df, "y").collect()}
    assert fractions == {0: 0.5, 1: 1.0}
    counts = {r["y"]: r["count"] for r in S.balanced_sample(df, "y", "id").groupBy("y").count().collect()}
    assert counts[1] == 200 and 900 < counts[0] < 1100


def test_folds_partition_the_ids(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    df = spark.range(300).withColumn("x", F.col("id") % 10).withColumn("label", (F.col("x") > 5).cast("int"))
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    got = S.out_of_fold_predictions(df, LogisticRegression(maxIter=3), "id", 3)
    assert got.count() == 300 and got.select("id").distinct().count() == 300
    assert got.groupBy("fold").count().count() == 3


def test_draws_compose(spark):
    """A draw leaves all buckets of the next kind of draw filled."""
    df = spark.range(20_000).withColumn("y", (F.col("id") % 20 == 0).cast("int"))
    balanced = S.balanced_sample(df, "y", "id", max_imbalance=2.0)
    for part, share in zip(S.hash_split(balanced, "id", [0.9, 0.1]), (0.9, 0.1)):
        counts = {r["y"]: r["count"] for r in part.groupBy("y").count().collect()}
        assert counts[1] == pytest.approx(1000 * share, rel=0.25) and counts[0] == pytest.approx(2000 * share, rel=0.25)
    sample = S.hash_sample(df, "id", 0.11)
    assert [p.count() for p in S.hash_split(sample, "id", [0.8, 0.2])] == pytest.approx([1760, 440], rel=0.2)
    half = S.hash_sample(df, "id", 0.5)
    assert S.hash_sample(half, "id", 0.5).count() == half.count()
    assert S.hash_sample(half, "id", 0.5, seed=1).count() == pytest.approx(5000, rel=0.1)
    folds = {r["fold"]: r["count"] for r in S.with_fold(sample, "id", 5).groupBy("fold").count().collect()}
    assert len(folds) == 5 and min(folds.values()) > 350


def test_profile(spark):
    df = spark.createDataFrame([("a", 1, 0.0), ("a", 0, 10.0), ("b", 1, 5.0), (None, 1, None)], "k string, y int, v double")
    assert {tuple(r) for r in P.crosstab(df, "k", "y", [0, 1]).collect()} == {("a", 1, 1), ("b", 0, 1), (None, 0, 1)}
    assert {r["k"] for r in P.value_stats(df, "v", ["k"], ["k"]).collect()} == {"a", "b"}
    bins = {r["bin"]: r["n"] for r in P.histogram(df, "v", 5).collect()}
    assert bins == {0: 1, 1: 0, 2: 1, 3: 0, 4: 1}
    flat = P.histogram(df.withColumn("v", F.lit(3.0)), "v", 3).collect()
    assert sum(r["n"] for r in flat) == 4
    with pytest.raises(ValueError):
        P.histogram(df.filter("v < 0"), "v")
    approx = {r["prob"]: r["quantile"] for r in P.quantiles_approx(df, "v", [0.0, 0.5, 1.0]).collect()}
    assert approx == {0.0: 0.0, 0.5: 5.0, 1.0: 10.0}
    with pytest.raises(PySparkException, match="more than one"):
        P.wide(df, ["y"], "k", "v", ["a", "b"]).unionByName(P.wide(df.union(df), ["y"], "k", "v", ["a", "b"])).collect()


ROWS = [(1, "x", 1.0, 0), (2, "y", None, 1), (3, None, 3.0, 1), (4, "x", 5.0, 0)]
SCHEMA = "id int, s string, v double, y int"


def test_pipeline(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    filled = df.fillna({"s": "", "v": 0.0})
    fitted = FE.feature_pipeline(filled, ["id", "y"], scale=None).fit(filled)
    got = {r["id"]: list(r["vectorized"]) for r in fitted.transform(filled).collect()}
    assert got == {1: [1, 1], 2: [2, 0], 3: [0, 3], 4: [1, 5]}
    unseen = spark.createDataFrame([(9, "new", 1.0, 0)], SCHEMA)
    assert list(fitted.transform(unseen).first()["vectorized"]) == [3, 1]
    skipping = FE.feature_pipeline(filled, ["id", "y"], scale=None, handle_invalid="skip").fit(filled)
    assert skipping.transform(unseen).count() == 0
    imputing = FE.feature_pipeline(df.fillna({"s": ""}), ["id", "y"], scale="minmax", impute="mean")
    model = imputing.fit(df.fillna({"s": ""}))
    assert {r["id"]: r["normalized"][1] for r in model.transform(df.fillna({"s": ""})).collect()}[2] == 0.5
    with pytest.raises(ValueError):
        FE.scaler("other")


def test_vector_names(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).fillna({"s": ""})
    ready = FE.feature_pipeline(df, ["id", "y"], impute="mean").fit(df).transform(df)
    assert FE.vector_names(ready) == ["s_INT", "v_imputed"]
    with pytest.raises(ValueError):
        FE.vector_names(ready, "s_INT")


def test_too_many_categories(spark):
    df = spark.range(50).withColumn("s", F.col("id").cast("string"))
    with pytest.raises(ValueError, match="categories"):
        FE.categories(df, ["s"], max_categories=10)
    with pytest.raises(ValueError, match="categories"):
        FE.feature_pipeline(df, ["id"], max_categories=10)


def test_auto_features(spark):
    train = spark.createDataFrame(ROWS, SCHEMA)
    config = FE.TrainingSet("id", "y", "classification")
    fitted = FE.AutoFeatures(config).fit(train)
    assert fitted.columns == ("v", "s__-9999", "s__x", "s__y")
    assert [tuple(r) for r in fitted.transform(train).collect()][2] == (3, 1, 3.0, 1, 0, 0)
    test = spark.createDataFrame([(7, "z", 2.0, "?"), (8, "x", None, "?")], "id int, s string, extra double, more string")
    assert [tuple(r) for r in fitted.transform(test).collect()] == [(7, -9999, 0, 0, 0), (8, -9999, 0, 1, 0)]


def test_config(spark):
    config = FE.TrainingSet("id", "y", "regression", date_field="d")
    assert config.kind == "time_series"
    assert FE.TrainingSet("id", "y", "classification", date_field="d").kind == "classification"
    assert config.fill == -9999


def test_hook_and_dates(spark):
    df = spark.createDataFrame([(1, "2021-01-03", 2.0)], "id int, d string, y double").withColumn("d", F.to_date("d"))
    config = FE.TrainingSet("id", "y", "regression", "d", hook=lambda f: f.withColumn("twice", F.col("d_MonthOfYear") * 2))
    fitted = FE.AutoFeatures(config).fit(df)
    assert fitted.transform(df).first()["twice"] == 2
