"""Samples, splits and folds."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from liftspark.operators import models
from liftspark.operators import sampling as S
from liftspark.plans.registry import query
from liftspark.plans.tables import JOBS_SQL, jobs, order_facts, table
from liftspark.session import checkpointed



def bucket_sql(purpose: str, buckets: int = 10_000, id: str = "o_orderkey", seed: int | str = 0) -> str:
    """The hash bucket of an id for one kind of draw."""
    return f"(('0x' || substr(md5('{purpose}-{seed}:' || CAST({id} AS VARCHAR)), 1, 8))::BIGINT % {buckets})"


SAMPLE, SPLIT = bucket_sql("sample"), bucket_sql("split")
STRATUM = bucket_sql("stratum", id="jobid")
BALANCED_SQL = f"""c AS (SELECT final_response AS y, count(*) AS n FROM jobs GROUP BY 1),
    f AS (SELECT y, round(least(min(n) OVER () * CAST(2.0 AS DOUBLE), n) / n * 10000) AS cap FROM c),
    balanced AS (SELECT jobid, final_response FROM jobs JOIN f ON final_response = y WHERE {STRATUM} < cap)"""


@query("hash_sample", f"SELECT o_orderkey, o_totalprice FROM orders WHERE {SAMPLE} < 1100")
def hash_sample(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return S.hash_sample(orders, "o_orderkey", 0.11, "md5")


@query(
    "hash_split",
    f"SELECT o_orderkey, CASE WHEN {SPLIT} < 8000 THEN 0 ELSE 1 END AS split FROM orders",
)
def hash_split(spark, sf_dir):
    split = S.split_column("o_orderkey", [0.8, 0.2], "md5")
    return table(spark, sf_dir, "orders").select("o_orderkey", split.alias("split"))


@query(
    "stratified_sample",
    f"""WITH {JOBS_SQL} SELECT jobid, region FROM jobs WHERE (region = 'ASIA' AND {STRATUM} < 4000)
      OR (region = 'EUROPE' AND {STRATUM} < 1000) OR region = 'AFRICA'""",
)
def stratified_sample(spark, sf_dir):
    fractions = {"ASIA": 0.4, "EUROPE": 0.1, "AFRICA": 1.0, "AMERICA": 0.0}
    found = S.stratified_sample(jobs(spark, sf_dir), "region", "jobid", fractions, hash_fn="md5")
    return found.select("jobid", "region")


@query(
    "balanced_sample",
    f"WITH {JOBS_SQL}, {BALANCED_SQL} SELECT jobid, final_response FROM balanced",
)
def balanced_sample(spark, sf_dir):
    rows = order_facts(spark, sf_dir).select("jobid", "final_response")
    return S.balanced_sample(rows, "final_response", "jobid", max_imbalance=2.0, hash_fn="md5")


@query(
    "sample_then_split",
    f"""SELECT CASE WHEN {SPLIT} < 8000 THEN 0 ELSE 1 END AS split, count(*) AS n FROM orders WHERE {SAMPLE} < 1100 GROUP BY 1""",
)
def sample_then_split(spark, sf_dir):
    """An 11% sample, then 80/20: both sides have their share."""
    chosen = S.hash_sample(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 0.11, "md5")
    return chosen.groupBy(S.split_column("o_orderkey", [0.8, 0.2], "md5").alias("split")).agg(F.count("*").alias("n"))


@query(
    "sample_of_sample",
    f"SELECT o_orderkey FROM orders WHERE {bucket_sql('sample', seed='a')} < 5000 AND {bucket_sql('sample', seed='b')} < 5000",
)
def sample_of_sample(spark, sf_dir):
    half = S.hash_sample(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 0.5, "md5", "a")
    return S.hash_sample(half, "o_orderkey", 0.5, "md5", "b")


@query(
    "balanced_then_split",
    f"""WITH {JOBS_SQL}, {BALANCED_SQL} SELECT CASE WHEN {bucket_sql('split', id='jobid')} < 9000 THEN 0 ELSE 1 END AS split,
      final_response, count(*) AS n FROM balanced GROUP BY ALL""",
)
def balanced_then_split(spark, sf_dir):
    """Class counts on either side of a 90/10 split of a balanced sample."""
    rows = order_facts(spark, sf_dir).select("jobid", "final_response")
    chosen = S.balanced_sample(rows, "final_response", "jobid", max_imbalance=2.0, hash_fn="md5")
    split = S.split_column("jobid", [0.9, 0.1], "md5").alias("split")
    return chosen.groupBy(split, "final_response").agg(F.count("*").alias("n"))


@query(
    "sample_then_folds",
    f"SELECT {bucket_sql('fold', 5)}::INTEGER AS fold, count(*) AS n FROM orders WHERE {SAMPLE} < 1100 GROUP BY 1",
)
def sample_then_folds(spark, sf_dir):
    chosen = S.hash_sample(table(spark, sf_dir, "orders"), "o_orderkey", 0.11, "md5")
    return S.with_fold(chosen, "o_orderkey", 5, "md5").groupBy("fold").agg(F.count("*").alias("n"))


@query("fold_sizes", f"SELECT {bucket_sql('fold', 3)}::INTEGER AS fold, count(*) AS n FROM orders GROUP BY 1")
def fold_sizes(spark, sf_dir):
    tagged = S.with_fold(table(spark, sf_dir, "orders"), "o_orderkey", 3, "md5")
    return tagged.groupBy("fold").agg(F.count("*").alias("n"))


@query("oof_predictions", "SELECT o_orderkey AS jobid, count(*) AS n_predictions FROM orders GROUP BY 1")
def oof_predictions(spark, sf_dir):
    """Every row gets exactly one prediction, from a model that has not seen it."""
    rows = order_facts(spark, sf_dir).select("jobid", "final_response", F.col("o_totalprice").alias("price"))
    vectors = VectorAssembler(inputCols=["price"], outputCol="features").transform(rows)
    ready = checkpointed(vectors.select("jobid", "final_response", "features"))
    estimator, _ = models.classifier("LR", "features")
    predicted = S.out_of_fold_predictions(ready, estimator, "jobid", 3)
    return predicted.filter(F.col("predict_prob").isNotNull()).groupBy("jobid").agg(F.count("*").alias("n_predictions"))
