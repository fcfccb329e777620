"""Scalar expressions: rounding, dates, tags, bins, predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: Column | str, digits: int = 4) -> Column:
    """Half-up rounding by arithmetic on doubles, the same in every engine."""
    scale = F.lit(float(10**digits))
    return F.floor(_col(c).cast("double") * scale + F.lit(0.5)).cast("double") / scale


def rounded(df: DataFrame, cols: Sequence[str], digits: int = 4) -> DataFrame:
    """Round the listed columns half up, in one projection."""
    text = f"cast(floor(cast(`{{c}}` AS DOUBLE) * 1e{digits}D + 0.5D) AS DOUBLE) / 1e{digits}D AS `{{c}}`"
    chosen = set(cols)
    return df.selectExpr(*[text.format(c=c) if c in chosen else f"`{c}`" for c in df.columns])


def date_parts(df: DataFrame, date_col: str, keep: bool = False) -> DataFrame:
    """Weekday (Monday = 0), day of month and year, ISO week and month."""
    c = F.col(date_col)
    out = df.withColumns(
        {
            f"{date_col}_DayOfWeek": F.weekday(c),
            f"{date_col}_DayOfMonth": F.dayofmonth(c),
            f"{date_col}_DayOfYear": F.dayofyear(c),
            f"{date_col}_WeekOfYear": F.weekofyear(c),
            f"{date_col}_MonthOfYear": F.month(c),
        }
    )
    return out if keep else out.drop(date_col)


def with_lift_tags(df: DataFrame, key_col: str) -> DataFrame:
    """Split keys such as ``train_top_sales_mob`` into the tag columns.

    The first part is the test type and the third the capture type. A fourth
    part names the product; keys without one stand for all products.
    """
    parts = F.split(F.col(key_col), "_")
    return df.withColumns(
        {
            "test_type": F.get(parts, F.lit(0)),
            "capture_type": F.get(parts, F.lit(2)),
            "prod_type": F.when(F.size(parts) > 3, F.element_at(parts, -1)).otherwise(F.lit("all")),
        }
    )


def group_tag(group: Column | str, tag: Column | str) -> Column:
    return F.concat_ws("_", _col(group).cast("string"), _col(tag))


def split_group_tag(df: DataFrame, col: str = "group_tag") -> DataFrame:
    """Undo :func:`group_tag`; only the first underscore separates."""
    parts = F.split(F.col(col), "_", 2)
    return df.withColumns({"group": F.get(parts, F.lit(0)), "tag": F.get(parts, F.lit(1))}).drop(col)


def add_run_tag(df: DataFrame, run_tag: Column | str, col: str = "tag") -> DataFrame:
    suffix = F.lit(run_tag) if isinstance(run_tag, str) else run_tag
    return df.withColumn(col, F.concat(F.col(col), F.lit("_"), suffix))


def feature_base_name(c: Column | str) -> Column:
    """Feature name without the suffixes that imputing and indexing add."""
    return F.replace(F.replace(_col(c), F.lit("_imputed"), F.lit("")), F.lit("_index"), F.lit(""))


def as_array(df: DataFrame, col: str) -> Column:
    """A vector or array column as ``array<double>``."""
    if isinstance(df.schema[col].dataType, VectorUDT):
        return vector_to_array(F.col(col))
    return F.col(col).cast("array<double>")


def last_probability(df: DataFrame, col: str) -> Column:
    """Score of the positive class: the last element, or the number itself."""
    if isinstance(df.schema[col].dataType, T.NumericType):
        return F.col(col).cast("double")
    return F.element_at(as_array(df, col), -1)


def flatten_vector(df: DataFrame, col: str, size: int, prefix: str = "e") -> DataFrame:
    """One double column per vector element, in place of the vector."""
    others = [f"`{c}`" for c in df.columns if c != col]
    elements = [f"get(_values, {i}) AS `{prefix}{i}`" for i in range(size)]
    return df.withColumn("_values", as_array(df, col)).selectExpr(*others, *elements)


def scrub_prediction(task: str, prediction: Column | str, probability: Column | str | None = None) -> Column:
    """The value to report for a task.

    Propensity reports the probability, classification the class at the 0.5
    threshold, multiclass the prediction, and regression the prediction with
    negatives raised to zero. Missing values stay missing.
    """
    if task == "propensity":
        return _col(probability)
    if task == "classification":
        p = _col(probability)
        return F.when(p.isNotNull(), (p > 0.5).cast("int"))
    if task == "multiclassClassification":
        return _col(prediction)
    if task in ("regression", "time_series"):
        p = _col(prediction)
        return F.when(p < 0, F.lit(0.0)).otherwise(p)
    raise ValueError(f"unknown task {task!r}")


def cut(
    c: Column | str, edges: Sequence[float], labels: Sequence, include_lowest: bool = False
) -> Column:
    """Right-closed bins ``(edge, next edge]``; null outside of all of them."""
    if len(labels) != len(edges) - 1 or list(edges) != sorted(set(edges)):
        raise ValueError("edges must increase, with one label per bin")
    value = _col(c)
    out = None
    for i, label in enumerate(labels):
        lower = value >= edges[i] if include_lowest and i == 0 else value > edges[i]
        hit = lower & (value <= edges[i + 1])
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out
