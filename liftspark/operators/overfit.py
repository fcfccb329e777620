"""Comparing lift tables across segments, data sets and runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftspark.functions.columns import add_run_tag
from liftspark.operators.gain import gain_table
from liftspark.operators.profile import wide

# Tag columns of a lift table, data sets compared, alert line.
SEGMENT_KEYS = ("tag", "test_type", "capture_type", "prod_type")
TEST_TYPES = ("train", "test1", "test2")
OVERFIT_ALERT = -0.02
NATIONAL = "national"


def gain_by_segment(df: DataFrame, score: str, label: str, id: str, **options) -> DataFrame:
    """The lift table in long form: one gain table per segment."""
    return gain_table(df, score, label, id, keys=SEGMENT_KEYS, **options)


def first_deciles(
    lift: DataFrame, low: float, high: float, by: str, values: Sequence[str], index: Sequence[str], value: str = "gain_cum"
) -> DataFrame:
    """Bands ``low`` to ``high`` with one column per tag or data set."""
    return wide(lift.filter(F.col("group").between(low, high)), index, by, value, values)


def sales_counts(lift: DataFrame) -> DataFrame:
    """Visits and responders at each decile: all segments together against the national model."""
    deciles = F.array(*[F.lit((i + 1) / 10.0) for i in range(10)])
    national = F.col("tag") == NATIONAL

    def total(col: str, side) -> F.Column:
        return F.sum(F.when(side, F.col(col))).cast("bigint")

    return (
        lift.filter(F.array_contains(deciles, F.col("group")))
        .groupBy("prod_type", "test_type", "group")
        .agg(
            total("size_cum", ~national).alias("size_cum_indiv"),
            total("resp_num_cum", ~national).alias("resp_num_cum_indiv"),
            total("size_cum", national).alias("size_cum_natio"),
            total("resp_num_cum", national).alias("resp_num_cum_natio"),
        )
    )


def relative_change(df: DataFrame, base: str = "train", tests: Sequence[str] = ("test1", "test2")) -> DataFrame:
    """Add ``train_test1`` and so on: the change against the base column, as a share of it."""
    return df.withColumns(
        {f"{base}_{t}": F.try_divide(F.col(t) - F.col(base), F.col(base)) for t in tests}
    )


def overfit_delta(
    lift: DataFrame, value: str = "gain_cum", capture_type: str = "sales", prod_type: str = "mob"
) -> DataFrame:
    """Train against test for each band, a number, and tag."""
    by_set = wide(
        lift.where((F.col("prod_type") == prod_type) & (F.col("capture_type") == capture_type)), ["group", "tag"], "test_type", value, TEST_TYPES
    )
    return relative_change(by_set)


def overfit_flags(
    delta: DataFrame, group: float, by: str = "train_test1", threshold: float | None = OVERFIT_ALERT
) -> DataFrame:
    """Tags at one band, largest change first, above the threshold."""
    rows = delta.filter(F.abs(F.col("group") - F.lit(float(group))) < 1e-9)
    if threshold is not None:
        rows = rows.filter(F.col(by) > threshold)
    return rows.orderBy(F.col(by).desc(), "tag")


def stack(tables: dict[str, DataFrame]) -> DataFrame:
    """One table from several runs, each with its run name added to the tag."""
    out = None
    for run_tag, table in tables.items():
        tagged = add_run_tag(table, run_tag)
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out
