"""One-hot encoding of any number of categories, as sparse vectors.

The dictionary of categories is a table: distinct values, numbered in order within their column by a distributed ranking. Rows
find their numbers by joins with it, which broadcast a part only when its counted size allows; neither values nor rows reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftspark.operators.prefix import ordered_prefix
from liftspark.session import checkpointed

#: Dictionary rows of one column, of values of ``MAX_BYTES`` in all, that a join may broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 16 << 20


@dataclass(frozen=True)
class Categories:
    """``table`` has ``column, value, place``; ``counts`` the categories and ``sizes`` the bytes of each column's values."""

    table: DataFrame
    columns: tuple[str, ...]
    counts: dict[str, int]
    sizes: dict[str, int]

    @property
    def offsets(self) -> dict[str, int]:
        """Where each column's indicators begin in the vector."""
        out, at = {}, 0
        for c in self.columns:
            out[c] = at
            at += self.counts[c]
        return out

    @property
    def width(self) -> int:
        return sum(self.counts.values())


def fit_categories(df: DataFrame, columns: Sequence[str]) -> Categories:
    """Distinct values of each column as text, numbered from 0 in the order of their bytes; null is no category."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])).alias("p")
    found = checkpointed(df.select(pairs).select("p.column", "p.value").filter("value is not null").distinct().withColumn("same", F.lit(0.0)))
    table = checkpointed(ordered_prefix(found, "same", "value", keys=["column"], descending=False, rank_col="place").select("column", "value", "place"))
    counted = table.groupBy("column").agg(F.count("*").alias("n"), F.sum(F.octet_length("value") + 24).alias("size")).collect()  # a row a column
    counts, sizes = {r["column"]: r["n"] for r in counted}, {r["column"]: r["size"] for r in counted}
    return Categories(table, tuple(columns), {c: counts.get(c, 0) for c in columns}, {c: sizes.get(c, 0) for c in columns})


def place_column(column: str) -> str:
    return f"{column}__place"


def with_places(df: DataFrame, categories: Categories) -> DataFrame:
    """Adds ``<column>__place``: the number of the row's category, null for a null or unknown value."""
    for c in categories.columns:
        own = categories.table.filter(F.col("column") == c).select(F.col("value").alias("_value"), F.col("place").alias(place_column(c)))
        if categories.counts[c] <= BROADCAST_ROWS and categories.sizes[c] <= BROADCAST_BYTES:
            own = F.broadcast(own)
        df = df.join(own, F.col(f"`{c}`").cast("string") == F.col("_value"), "left").drop("_value")
    return df


def one_hot_sparse(df: DataFrame, categories: Categories, indices: str = "indices") -> DataFrame:
    """Replaces the columns by the positions of their ones in a vector of ``categories.width``, ascending."""
    offsets = categories.offsets
    at = [F.col(f"`{place_column(c)}`") + F.lit(offsets[c]) for c in categories.columns]
    kept = [F.col(f"`{c}`") for c in df.columns if c not in categories.columns]
    return with_places(df, categories).select(*kept, F.array_compact(F.array(*at)).alias(indices))


def sparse_features(df: DataFrame, categories: Categories, numeric: Sequence[str] = (), output: str = "features") -> DataFrame:
    """Adds a sparse vector: the numeric columns, then the indicators of each categorical column.

    A value without a category, null too, has no indicator. Built by the library's own encoder and assembler, without Python.
    """
    placed = with_places(df, categories)
    indexed, encoded = [f"{place_column(c)}_index" for c in categories.columns], [f"{place_column(c)}_vector" for c in categories.columns]
    for c, name in zip(categories.columns, indexed):
        n = categories.counts[c]
        # one number more, for no category, which the encoder drops as the last
        about = {"ml_attr": {"type": "nominal", "name": name, "num_vals": max(n, 1) + 1}}
        placed = placed.withColumn(name, F.coalesce(F.col(f"`{place_column(c)}`"), F.lit(max(n, 1))).cast("double").alias(name, metadata=about))
    if categories.columns:
        placed = OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True).fit(placed).transform(placed)
    ready = VectorAssembler(inputCols=[*numeric, *encoded], outputCol=output, handleInvalid="error").transform(placed)
    return ready.drop(*indexed, *encoded, *map(place_column, categories.columns))
