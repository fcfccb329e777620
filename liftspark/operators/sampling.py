"""Samples, splits and folds that depend on the row id, not on partitioning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftspark.functions.hashing import hash_bucket
from liftspark.operators.profile import class_fractions

BUCKETS = 10_000


def _salt(purpose: str, seed: int | str) -> str:
    """Each kind of draw has a hash of its own, so that one can follow another; ``seed`` tells repeated draws apart."""
    return f"{purpose}-{seed}"


def hash_sample(df: DataFrame, id: str, fraction: float, hash_fn: str = "murmur3", seed: int | str = 0) -> DataFrame:
    """About ``fraction`` of the rows: the same rows each time. Draw again with another ``seed``."""
    return df.filter(hash_bucket(id, BUCKETS, hash_fn, _salt("sample", seed)) < F.lit(round(fraction * BUCKETS)))


def split_column(id: str, weights: Sequence[float], hash_fn: str = "murmur3", seed: int | str = 0) -> Column:
    """Index of the split that a row falls into, by weight."""
    total, reached, out = float(sum(weights)), 0.0, None
    bucket = hash_bucket(id, BUCKETS, hash_fn, _salt("split", seed))
    for i, weight in enumerate(weights[:-1]):
        reached += weight
        hit = bucket < F.lit(round(reached / total * BUCKETS))
        out = F.when(hit, F.lit(i)) if out is None else out.when(hit, F.lit(i))
    last = F.lit(len(weights) - 1)
    return last if out is None else out.otherwise(last)


def hash_split(df: DataFrame, id: str, weights: Sequence[float], hash_fn: str = "murmur3", seed: int | str = 0) -> list[DataFrame]:
    split = split_column(id, weights, hash_fn, seed)
    return [df.filter(split == i) for i in range(len(weights))]


def stratified_sample(
    df: DataFrame,
    col: str,
    id: str,
    fractions: Mapping | DataFrame,
    overall: float | None = None,
    hash_fn: str = "murmur3",
    seed: int | str = 0,
) -> DataFrame:
    """Keep a fraction of each class; classes without a fraction are left out.

    ``fractions`` maps classes (None for null) to shares, or is a table of ``col`` and ``fraction``,
    which may have any number of classes.
    """
    bucket = hash_bucket(id, BUCKETS, hash_fn, _salt("stratum", seed))
    if isinstance(fractions, DataFrame):
        shares = fractions.select(F.col(col).alias("_class"), F.col("fraction").alias("_share"))
        out = df.join(shares, F.col(col).eqNullSafe(F.col("_class")))
        out = out.filter(bucket < F.round(F.col("_share") * BUCKETS)).select(df["*"])
    else:
        keep = F.lit(False)
        for value, fraction in fractions.items():
            keep = keep | (F.col(col).eqNullSafe(F.lit(value)) & (bucket < round(fraction * BUCKETS)))
        out = df.filter(keep)
    return out if overall is None else hash_sample(out, id, overall, hash_fn, f"overall-{seed}")


def balanced_sample(
    df: DataFrame,
    label: str,
    id: str,
    max_imbalance: float = 5.0,
    overall: float | None = None,
    hash_fn: str = "murmur3",
    seed: int | str = 0,
) -> DataFrame:
    """Cap every class at a multiple of the smallest."""
    return stratified_sample(df, label, id, class_fractions(df, label, max_imbalance), overall, hash_fn, seed)


def with_fold(df: DataFrame, id: str, folds: int, hash_fn: str = "murmur3", col: str = "fold", seed: int | str = 0) -> DataFrame:
    return df.withColumn(col, hash_bucket(id, folds, hash_fn, _salt("fold", seed)))


def out_of_fold_predictions(
    df: DataFrame, estimator: Estimator, id: str, folds: int = 3, hash_fn: str = "murmur3"
) -> DataFrame:
    """Predict every row with a model that has not seen its fold."""
    tagged = with_fold(df, id, folds, hash_fn)
    out = None
    for fold in range(folds):
        model = estimator.fit(tagged.filter(F.col("fold") != fold))
        part = model.transform(tagged.filter(F.col("fold") == fold))
        out = part if out is None else out.unionByName(part)
    return out
