"""Point metrics, each from one aggregate over the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: probabilities are kept this far from 0 and 1 in the log-loss.
LOG_LOSS_CLIP = 1e-15


def _ratio(part: Column, whole: Column) -> Column:
    """A share that counts as zero when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def confusion_matrix(df: DataFrame, label: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys, label, predicted).agg(F.count("*").alias("n"))


def binary_metrics(df: DataFrame, label: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, accuracy and F1 of the class 1."""
    y, p = F.col(label) == 1, F.col(predicted) == 1
    counts = df.groupBy(*keys).agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(p).alias("said"),
        F.count_if(y).alias("true"),
        F.count_if(F.col(label) == F.col(predicted)).alias("same"),
        F.count("*").alias("n"),
    )
    return counts.select(
        *keys,
        _ratio(F.col("tp"), F.col("said")).alias("precision"),
        _ratio(F.col("tp"), F.col("true")).alias("recall"),
        _ratio(F.col("same"), F.col("n")).alias("accuracy"),
        _ratio(2 * F.col("tp"), F.col("said") + F.col("true")).alias("f1"),
    )


def multiclass_metrics(df: DataFrame, label: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    """Micro-averaged metrics.

    Every row has one label and one prediction, so each wrong row is one false
    positive and one false negative: all four values are the share of hits.
    """
    counts = df.groupBy(*keys).agg(
        F.count_if(F.col(label) == F.col(predicted)).alias("same"), F.count("*").alias("n")
    )
    share = _ratio(F.col("same"), F.col("n"))
    return counts.select(*keys, *[share.alias(c) for c in ("precision", "recall", "accuracy", "f1")])


def log_loss(df: DataFrame, label: str, probability: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean negative log-likelihood; a missing label or probability is an error."""
    given = F.col(probability).cast("double")
    missing = F.col(label).isNull() | given.isNull() | F.isnan(given)
    given = F.when(missing, F.raise_error(F.lit("null labels, or null or NaN probabilities"))).otherwise(given).cast("double")
    p = F.least(F.greatest(given, F.lit(LOG_LOSS_CLIP)), F.lit(1 - LOG_LOSS_CLIP))
    loss = -F.ln(F.when(F.col(label) == 1, p).otherwise(1 - p))
    return df.groupBy(*keys).agg(F.avg(loss).alias("log_loss"))


def regression_metrics(df: DataFrame, target: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean squared error and R² of the rows that have both; a constant target scores 1 if met exactly, else 0."""
    p = F.col(predicted).cast("double")
    y = F.when(p.isNotNull(), F.col(target).cast("double"))
    sums = df.groupBy(*keys).agg(F.avg((y - p) * (y - p)).alias("mse"), F.var_pop(y).alias("variance"))
    r2 = F.when(F.col("variance") == 0, (F.col("mse") == 0).cast("double")).otherwise(
        1 - F.try_divide(F.col("mse"), F.col("variance"))
    )
    return sums.select(*keys, "mse", r2.alias("r2"))
