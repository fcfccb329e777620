"""Counts, ranges, crosstabs, quantiles and histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from liftspark.operators.prefix import cumulative_at


def value_range(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(value).alias("min"), F.max(value).alias("max"))


def value_stats(df: DataFrame, value: str, keys: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """Min, max and average per group; groups with a null in ``required`` are left out.

    The filter names group keys only, so it runs before the aggregation.
    """
    stats = df.groupBy(*keys).agg(
        F.min(value).alias("min"), F.max(value).alias("max"), F.avg(value).alias("average")
    )
    return stats.dropna(subset=list(required)) if required else stats


def crosstab(df: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    """Counts per ``row`` with one column per value; the values are given, not searched."""
    table = df.groupBy(row).pivot(column, list(values)).agg(F.count(F.lit(1)))
    return table.fillna(0, [str(v) for v in values])


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(label).alias("count"))


def class_fractions(df: DataFrame, label: str, max_imbalance: float = 5.0) -> DataFrame:
    """Sampling fraction per class that caps it at a multiple of the smallest class."""
    counts = class_counts(df.filter(F.col(label).isNotNull()), label)
    cap = F.min("count").over(Window.partitionBy()) * F.lit(float(max_imbalance))  # one row per class
    n = F.col("count").cast("double")
    return counts.select(label, "count", (F.least(cap, n) / n).alias("fraction"))


def distinct_tags(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values of each column, as sorted (name, value) rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in cols])
    # distinct combinations first: they are few, so little is multiplied
    return df.select(*cols).distinct().select(F.inline(pairs)).distinct().orderBy("name", "value")


def quantiles(df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation between neighbours.

    Finds the order statistics by selection, without holding a column's values
    in one place. Nulls are left out.
    """
    shares = f"array({', '.join(f'{float(p)!r}D' for p in probs)})"
    place = "{p} * cast(n - 1 AS DOUBLE)"
    pair = f"array(floor({place}) + 1, least(floor({place}) + 2, n))".replace("{p}", "p")
    present = df.filter(F.col(value).isNotNull())
    at = cumulative_at(
        present, value, None, f"flatten(transform({shares}, p -> {pair}))", keys, descending=False
    )
    both = at.groupBy(*keys, F.expr("cast(cut DIV 2 AS INT) AS q")).agg(
        F.expr("max(if(cut % 2 = 0, value, NULL)) AS lo"),
        F.expr("max(if(cut % 2 = 1, value, NULL)) AS hi"),
        F.max("n").alias("n"),
    )
    spot = place.replace("{p}", "prob")
    return both.withColumn("prob", F.expr(f"element_at({shares}, q + 1)")).selectExpr(
        *[f"`{k}`" for k in keys], "prob", f"lo + (hi - lo) * ({spot} - floor({spot})) AS quantile"
    )


def quantiles_approx(df: DataFrame, value: str, probs: Sequence[float], accuracy: int = 10_000) -> DataFrame:
    """Quantiles within ``1 / accuracy`` of the rank, in one pass."""
    probs = [float(p) for p in probs]
    found = df.agg(F.percentile_approx(value, probs, accuracy).alias("found"))
    pairs = F.arrays_zip(F.array(*[F.lit(p) for p in probs]).alias("prob"), F.col("found").alias("quantile"))
    return found.select(F.inline(pairs).alias("prob", "quantile"))


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between the extremes; the last one is closed. Empty bins count 0."""
    present = df.filter(F.col(value).isNotNull())
    number = F.col(value).cast("double")
    wrong = F.count_if(F.isnan(number) | (F.abs(number) == float("inf")))
    lo, hi, wrong = present.agg(F.min(number), F.max(number), wrong).first()
    if wrong:
        raise ValueError(f"{wrong} values of {value!r} are NaN or infinite")
    if lo is None:
        raise ValueError(f"column {value!r} has no values")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    place = (F.col(value).cast("double") - F.lit(lo)) * F.lit(float(bins)) / F.lit(hi - lo)
    index = F.least(F.floor(place).cast("int"), F.lit(bins - 1))
    counts = present.groupBy(index.alias("bin")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (hi - lo) / bins
    return (
        every.join(counts, "bin", "left")
        .select(
            "bin",
            (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lower"),
            (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("upper"),
            F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
        )
    )


def wide(df: DataFrame, index: Sequence[str], column: str, value: str, values: Sequence[str]) -> DataFrame:
    """One column per value of ``column``; a repeated cell is an error."""
    once = F.when(F.count(value) > 1, F.raise_error(F.lit(f"more than one {value} per cell"))).otherwise(F.first(value, True))
    return df.groupBy(*index).pivot(column, list(values)).agg(once)
