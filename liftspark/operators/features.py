"""Feature engineering: indexing, assembly, scaling, one-hot, the automatic chain."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline
from pyspark.ml.feature import Imputer, MinMaxScaler, Normalizer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from liftspark.functions.columns import date_parts
from liftspark.functions.frames import (
    FILL_SENTINEL,
    apply_hook,
    column_classes,
    drop_tolerant,
    fill_sentinel,
    is_numeric,
    sanitize_name,
    sync_columns,
)

INDEX_SUFFIX = "_INT"
VECTOR_COL, SCALED_COL = "vectorized", "normalized"


def check_categories(df: DataFrame, cols: Sequence[str], max_categories: int | None) -> None:
    """Refuse columns with more than ``max_categories`` distinct values; no limit if that is None."""
    if not cols or max_categories is None:
        return
    counts = df.agg(*[F.count_distinct(c).alias(c) for c in cols]).first()
    wide = {c: counts[c] for c in cols if counts[c] > max_categories}
    if wide:
        raise ValueError(f"more than {max_categories} categories: {wide}")


def string_indexer(cols: Sequence[str], handle_invalid: str = "keep") -> StringIndexer:
    """Alphabetical index for all columns at once: one pass over the data, not one per column."""
    return StringIndexer(
        inputCols=list(cols),
        outputCols=[f"{c}{INDEX_SUFFIX}" for c in cols],
        stringOrderType="alphabetAsc",
        handleInvalid=handle_invalid,
    )


def feature_pipeline(
    df: DataFrame,
    exclude: Sequence[str],
    scale: str | None = "std",
    handle_invalid: str = "keep",
    strict: bool = False,
    impute: str | None = None,
    max_categories: int | None = None,
) -> Pipeline:
    """Index strings, assemble all features in schema order, and scale.

    ``scale`` is ``"std"``, ``"minmax"``, ``"l2"`` or ``None``; ``impute`` is
    ``"mean"`` or ``"median"``.
    """
    classes = column_classes(df, exclude, strict)
    check_categories(df, classes["string"], max_categories)
    stages, inputs = [], {c: c for c in classes["numeric"]}
    if classes["string"]:
        stages.append(string_indexer(classes["string"], handle_invalid))
        inputs.update({c: f"{c}{INDEX_SUFFIX}" for c in classes["string"]})
    if impute:
        fractional = [c for c in classes["numeric"] if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))]
        if fractional:
            stages.append(
                Imputer(strategy=impute, inputCols=fractional, outputCols=[f"{c}_imputed" for c in fractional])
            )
            inputs.update({c: f"{c}_imputed" for c in fractional})
    ordered = [inputs[c] for c in df.columns if c in inputs]
    stages.append(VectorAssembler(inputCols=ordered, outputCol=VECTOR_COL, handleInvalid=handle_invalid))
    if scale is not None:
        stages.append(scaler(scale))
    return Pipeline(stages=stages)


def vector_names(df: DataFrame, vector: str = VECTOR_COL) -> list[str]:
    """The names of a vector column's elements in their order, as the assembler noted them."""
    groups = df.schema[vector].metadata.get("ml_attr", {}).get("attrs", {})
    known = {a["idx"]: a.get("name", str(a["idx"])) for attrs in groups.values() for a in attrs}
    if not known or sorted(known) != list(range(len(known))):
        raise ValueError(f"column {vector!r} does not say what its elements are")
    return [known[i] for i in range(len(known))]


def scaler(kind: str, input_col: str = VECTOR_COL, output_col: str = SCALED_COL):
    if kind == "l2":
        return Normalizer(p=2.0, inputCol=input_col, outputCol=output_col)
    if kind == "minmax":
        return MinMaxScaler(inputCol=input_col, outputCol=output_col)
    if kind == "std":
        return StandardScaler(inputCol=input_col, outputCol=output_col)
    raise ValueError(f"unknown scaling {kind!r}")


def categories(df: DataFrame, cols: Sequence[str], max_categories: int | None = None) -> dict[str, list[str]]:
    """Sorted distinct values per column, found in one job.

    They become part of a fitted chain. With ``max_categories`` a column of more is refused before its values are read.
    """
    if not cols:
        return {}
    check_categories(df, cols, max_categories)
    sets = df.agg(*[F.collect_set(F.col(c).cast("string")).alias(c) for c in cols]).first()
    return {c: sorted(sets[c]) for c in cols}


def indicator_name(col: str, value: str) -> str:
    return sanitize_name(f"{col}__{value}")


def one_hot(df: DataFrame, values: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace each column by 0/1 columns ``column__value``; null is 0 in all of them."""
    flags = [
        F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("int"), F.lit(0)).alias(indicator_name(c, v))
        for c, known in values.items()
        for v in known
    ]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in values], *flags)


@dataclass(frozen=True)
class TrainingSet:
    """The columns and the task of a data set, as the automatic chain takes them."""

    row_id: str
    target: str
    task: str
    date_field: str = ""
    drop: tuple[str, ...] = ()
    fill: int = FILL_SENTINEL
    probability_col: str = "probability_positive"
    max_categories: int | None = None
    hook: Callable[[DataFrame], DataFrame] | None = None

    @property
    def kind(self) -> str:
        """The task; a regression over dates is a time series."""
        dated = self.task == "regression" and bool(self.date_field)
        return "time_series" if dated else self.task


@dataclass(frozen=True)
class AutoFeatures:
    """The fitted chain: columns and categories as seen in training."""

    config: TrainingSet
    columns: tuple[str, ...] = ()
    values: dict[str, list[str]] = field(default_factory=dict)

    def _cleaned(self, df: DataFrame) -> DataFrame:
        cfg = self.config
        if cfg.kind == "time_series":
            df = date_parts(df, cfg.date_field)
        df = drop_tolerant(apply_hook(df, cfg.hook), cfg.drop)
        own = (cfg.row_id, cfg.target)
        texts = {
            f.name: F.col(f"`{f.name}`").cast("string")
            for f in df.schema
            if f.name not in own and not is_numeric(f.dataType)
        }
        if texts:
            df = df.withColumns(texts)
        return fill_sentinel(df, cfg.fill, skip=own)

    def _texts(self, df: DataFrame) -> list[str]:
        own = (self.config.row_id, self.config.target)
        return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in own]

    def fit(self, df: DataFrame) -> "AutoFeatures":
        cleaned = self._cleaned(df)
        values = categories(cleaned, self._texts(cleaned), self.config.max_categories)
        own = (self.config.row_id, self.config.target)
        plain = [sanitize_name(c) for c in cleaned.columns if c not in values and c not in own]
        flags = [indicator_name(c, v) for c, known in values.items() for v in known]
        columns = (*plain, *flags)
        if len(set(columns)) < len(columns):
            raise ValueError("feature names collide after renaming")
        return AutoFeatures(self.config, columns, values)

    def transform(self, df: DataFrame) -> DataFrame:
        """Id, target if present, and the training columns in training order.

        A category that does not occur here is all zeros.
        """
        cfg, cleaned = self.config, self._cleaned(df)
        known = {c: v for c, v in self.values.items() if c in cleaned.columns}
        flags = [indicator_name(c, v) for c, values in self.values.items() for v in values]
        encoded = one_hot(cleaned, known)
        renamed = encoded.toDF(*[sanitize_name(c) for c in encoded.columns])
        return sync_columns(renamed, self.columns, (cfg.row_id, cfg.target), cfg.fill, indicators=flags)


def assembler(columns: Sequence[str], output_col: str = VECTOR_COL) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output_col, handleInvalid="error")
