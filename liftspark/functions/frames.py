"""Whole-frame clean-up: fills, drops, renames, column sync."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The numeric classes of the strict profile, and the fill value.
STRICT_NUMERIC = (T.IntegerType, T.BooleanType, T.DecimalType, T.DoubleType, T.FloatType)
FILL_SENTINEL = -9999


def is_numeric(data_type: T.DataType, strict: bool = False) -> bool:
    if strict:
        return isinstance(data_type, STRICT_NUMERIC)
    return isinstance(data_type, (T.NumericType, T.BooleanType))


def column_classes(
    df: DataFrame, exclude: Iterable[str] = (), strict: bool = False
) -> dict[str, list[str]]:
    """Column names by class, in schema order."""
    skip = set(exclude)
    out: dict[str, list[str]] = {"numeric": [], "string": [], "invalid": []}
    for field in df.schema:
        if field.name in skip:
            continue
        if is_numeric(field.dataType, strict):
            out["numeric"].append(field.name)
        elif isinstance(field.dataType, T.StringType):
            out["string"].append(field.name)
        else:
            out["invalid"].append(field.name)
    return out


def schema_profile(df: DataFrame, exclude: Iterable[str] = (), strict: bool = False) -> DataFrame:
    """One row per column: type, class and how many values are present."""
    classes = {c: k for k, cols in column_classes(df, exclude, strict).items() for c in cols}
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in classes])
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(df.schema[c].dataType.simpleString()).alias("type"),
                F.lit(k).alias("class"),
                F.col(c).alias("n_present"),
            )
            for c, k in classes.items()
        ]
    )
    return counts.select(F.inline(rows))


def fill_by_type(
    df: DataFrame, numeric: float = 0, string: str = "", boolean: bool | None = None, skip: Iterable[str] = ()
) -> DataFrame:
    """Fill nulls (and NaN) by column class; booleans only on request. Columns in ``skip``, such as keys, stay as they are."""
    keep = set(skip)
    cols = [f.name for f in df.schema if f.name not in keep]
    out = df.fillna(numeric, cols).fillna(string, cols) if cols else df
    if boolean is None:
        return out
    flags = [f.name for f in df.schema if isinstance(f.dataType, T.BooleanType) and f.name not in keep]
    return out.fillna(boolean, flags) if flags else out


def fill_sentinel(df: DataFrame, value: int = FILL_SENTINEL, skip: Iterable[str] = ()) -> DataFrame:
    """Replace null, NaN and both infinities by one value, in one projection.

    Strings get the text of the value. Columns of other types stay as they are.
    """
    keep = set(skip)

    def filled(field: T.StructField):
        c = F.col(field.name)
        if field.name in keep:
            return c
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            bad = c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
            return F.when(bad, F.lit(value).cast(field.dataType)).otherwise(c).alias(field.name)
        if isinstance(field.dataType, T.StringType):
            return F.coalesce(c, F.lit(str(value))).alias(field.name)
        if isinstance(field.dataType, T.NumericType):
            return F.coalesce(c, F.lit(value).cast(field.dataType)).alias(field.name)
        return c

    return df.select(*[filled(f) for f in df.schema])


def drop_tolerant(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop the listed columns that exist; repeats and unknown names are fine."""
    return df.drop(*dict.fromkeys(cols))


def sanitize_name(name: str) -> str:
    return re.sub(r"[\[\]<]", "__", name)


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Replace the characters ``[``, ``]`` and ``<`` of column names."""
    clean = [sanitize_name(c) for c in df.columns]
    twice = sorted({c for c in clean if clean.count(c) > 1})
    if twice:
        raise ValueError(f"columns collide after renaming: {twice}")
    return df.toDF(*clean)


def sync_columns(
    df: DataFrame,
    train_columns: Sequence[str],
    keep: Sequence[str] = (),
    fill: int = FILL_SENTINEL,
    indicators: Iterable[str] = (),
) -> DataFrame:
    """The train columns in train order, after the ``keep`` columns.

    A missing column is filled: 0 if it is an indicator, ``fill`` otherwise.
    Columns unknown to the train side go away.
    """
    present, flags = set(df.columns), set(indicators)
    quoted = [F.col(f"`{c}`") for c in keep if c in present]
    for c in train_columns:
        quoted.append(F.col(f"`{c}`") if c in present else F.lit(0 if c in flags else fill).alias(c))
    return df.select(*quoted)


def apply_hook(df: DataFrame, hook: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """Run a user's own feature step, if there is one."""
    return df if hook is None else df.transform(hook)
