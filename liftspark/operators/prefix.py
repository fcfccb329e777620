"""Global order without a global sort task.

Rows are ordered by score and, among equal scores, by id. Instead of sending
all of them to one task, the score range is split at approximate quantiles into
*cells* with about equal numbers of rows. Counts per cell are small and give
every cell its starting position; only what happens inside a cell needs its
rows, and each cell is one task's work.

A score that many rows share gets a cell of its own, which is split again at
quantiles of the id. As both sets of split points are equal-mass over all rows,
no part grows beyond a few times ``n / cells`` however the scores are tied or
the keys are skewed. Split points that are off cost balance, never correctness.

Small tables go the same way as large ones: there are at least as many cells as
shuffle partitions, and one cell per ``ROWS_PER_CELL`` rows beyond that.
"""

from __future__ import annotations

import math
import os
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import groupby

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from liftspark.session import checkpointed

ROWS_PER_CELL = 1_000_000
FINE_CELLS = 1_024
MIN_SAMPLE, SAMPLE_PER_CELL = 200_000, 20

_RESULT_NAMES = {"cut", "rank", "n", "total", "cum", "value"}
_FIRST_TO_HERE = (Window.unboundedPreceding, Window.currentRow)
_ALL_BEFORE = (Window.unboundedPreceding, -1)


@dataclass(frozen=True)
class Cells:
    """Split points of score and id, and the counts they were planned from."""

    n_rows: int
    n_keys: int
    n_empty_keys: int
    score_splits: tuple[float, ...]
    tied: tuple[int, ...]
    id_splits: tuple[float, ...]
    descending: bool
    keyed: bool
    id_skip: int = 0
    """Bytes that all text ids begin with alike."""

    @property
    def key(self) -> list[str]:
        return ["_key"] if self.keyed else []

    @property
    def part(self) -> list[str]:
        return [*self.key, "_cell", *(["_sub"] if self.tied else [])]


def prepared(
    df: DataFrame, score: str, id: str | None, keys: Sequence[str], descending: bool = True, nulls: str = "error"
) -> DataFrame:
    """Add the ordering columns ``_key``, ``_score`` and ``_id``.

    Missing scores are an error by default; ``nulls="last"`` puts them last. Ids are numbers or
    text. Scores that a double may not hold exactly keep their own type in ``_exact``, which orders
    them where doubles are equal.
    """
    if nulls not in ("error", "last"):
        raise ValueError("nulls must be 'error' or 'last'")
    # adding zero turns -0.0 into 0.0, which compares equal but splits apart
    value = F.col(score).cast("double") + F.lit(0.0)
    if nulls == "last":
        last = F.lit(float("-inf") if descending else float("inf"))
        value = F.when(value.isNull() | F.isnan(value), last).otherwise(value)
    out = {"_score": value}
    if isinstance(df.schema[score].dataType, (T.LongType, T.DecimalType)):
        out["_exact"] = F.col(score)
    if id is not None:
        if not isinstance(df.schema[id].dataType, (T.NumericType, T.StringType)):
            raise TypeError(f"the tie-breaking id {id!r} must be a number or text")
        out["_id"] = F.col(id)
    if keys:
        # a struct is never null itself, so null keys form a segment and join
        out["_key"] = F.struct(*[F.col(k) for k in keys])
    return df.withColumns(out)


def _exact_ties(kind: T.DataType | None) -> float:
    """Up to which size equal doubles mean equal scores."""
    if isinstance(kind, T.LongType):
        return 2.0**53
    return math.inf if not isinstance(kind, T.DecimalType) or kind.precision <= 15 else -1.0


def _id_number(rows: DataFrame, skip: int) -> F.Column:
    """A double that never falls as the id grows; of a text the six bytes after the first ``skip``."""
    if isinstance(rows.schema["_id"].dataType, T.StringType):
        return F.expr(f"cast(conv(rpad(hex(substring(cast(_id AS BINARY), {skip + 1}, 6)), 12, '0'), 16, 10) AS DOUBLE)")
    return F.col("_id").cast("double")


def plan_cells(rows: DataFrame, descending: bool = True, measure: str | None = None) -> Cells:
    """Count the rows, check the scores and choose the split points."""
    keyed, has_id = "_key" in rows.columns, "_id" in rows.columns
    has_text = has_id and isinstance(rows.schema["_id"].dataType, T.StringType)
    ends = [F.min("_id").alias("low"), F.max("_id").alias("high")] if has_text else []
    counts = rows.groupBy(*(["_key"] if keyed else [])).agg(
        F.count("*").alias("n"),
        F.expr("count_if(_score IS NULL OR isnan(_score))").alias("bad"),
        (F.sum(measure) if measure else F.count("*")).alias("m"),
        *ends,
    )
    got = counts.selectExpr(
        "sum(n) AS n",
        *(["min(low) AS low", "max(high) AS high"] if has_text else []),
        "sum(bad) AS bad",
        "count_if(n > 0) AS keys",
        "count_if(n > 0 AND coalesce(m, 0) = 0) AS empty",
    ).first()
    n, n_keys = got["n"] or 0, max(got["keys"], 1)
    if got["bad"]:
        raise ValueError(f"{got['bad']} of {n} scores are null or NaN")

    # counts per cell are cheap, and finer cells leave fewer rows to rank
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    k = max(math.ceil(n / ROWS_PER_CELL), min(FINE_CELLS, n // 1_000), min(parts, n))
    skip = len(os.path.commonprefix([(got["low"] or "").encode(), (got["high"] or "").encode()])) if has_text else 0
    cols = ["_score", "_place"] if has_id else ["_score"]
    placed = rows.withColumn("_place", _id_number(rows, skip)) if has_id else rows
    found: list[list[float]] = [[] for _ in cols]
    if k > 1:
        wanted = max(MIN_SAMPLE, SAMPLE_PER_CELL * k)
        sample = placed if n <= wanted else placed.sample(wanted / n, seed=42)
        found = sample.approxQuantile(cols, [i / k for i in range(1, k)], 1 / (10 * k))

    exact = _exact_ties(rows.schema["_exact"].dataType if "_exact" in rows.columns else None)
    splits: set[float] = set()
    heavy: list[float] = []
    for value, run in groupby(found[0]):
        after = math.nextafter(value, math.inf)
        if math.isfinite(value):
            splits.add(value)
        if len(list(run)) > 1 and (math.isinf(value) or math.isfinite(after)):
            splits.update(v for v in (after,) if math.isfinite(value))
            if math.isinf(value) or abs(value) < exact:
                heavy.append(value)
    ordered = sorted(splits)
    # cells from below: one for -inf, the ranges between split points, one for inf
    position = {v: i + 2 for i, v in enumerate(ordered)} | {-math.inf: 0, math.inf: len(ordered) + 2}
    tied = [position[v] for v in heavy] if has_id else []
    if descending:
        tied = [len(ordered) + 2 - i for i in tied]
    return Cells(
        n_rows=n,
        n_keys=n_keys,
        n_empty_keys=got["empty"],
        score_splits=tuple(ordered),
        tied=tuple(sorted(tied)),
        id_splits=tuple(sorted(set(found[1]))) if has_id else (),
        descending=descending,
        keyed=keyed,
        id_skip=skip,
    )


def _bucket(rows: DataFrame, col: str, splits: Sequence[float], out: str) -> DataFrame:
    if not splits:
        return rows.withColumn(out, F.lit(0))
    bounds = [-math.inf, *splits, math.inf]
    found = Bucketizer(splits=bounds, inputCol=col, outputCol=out).transform(rows)
    # scores were checked; a non-null cell spares the joins a null filter
    return found.withColumn(out, F.coalesce(F.col(out).cast("int"), F.lit(0)))


def assign_cells(rows: DataFrame, cells: Cells) -> DataFrame:
    """Add ``_cell`` (0 comes first) and, where scores are tied, ``_sub``."""
    last = len(cells.score_splits) + 2
    place = f"CASE WHEN _score = double('-inf') THEN 0 WHEN _score = double('inf') THEN {last} ELSE _cell + 1 END"
    out = _bucket(rows, "_score", cells.score_splits, "_cell")
    out = out.withColumn("_cell", F.expr(f"{last} - {place}" if cells.descending else place))
    if cells.tied:
        out = _bucket(out.withColumn("_idd", _id_number(out, cells.id_skip)), "_idd", cells.id_splits, "_sub")
        out = out.withColumn("_sub", F.expr(f"if({_in_tie(cells)}, _sub, 0)")).drop("_idd")
    return out


def _in_tie(cells: Cells) -> str:
    return f"_cell IN ({', '.join(map(str, cells.tied))})"


def inside_order(cells: Cells, columns: Sequence[str]) -> Window:
    """The window over one part, in ranking order, of rows that have these columns."""
    scores = [F.col(c) for c in ("_score", "_exact") if c in columns]
    by = [c.desc_nulls_last() if cells.descending else c.asc_nulls_last() for c in scores]
    return Window.partitionBy(*cells.part).orderBy(*by, *([F.col("_id").asc()] if "_id" in columns else []))


def part_offsets(rows: DataFrame, cells: Cells, sums: Sequence[str]) -> DataFrame:
    """Totals of all rows before each part, as ``_before_n`` and ``_before_<sum>``."""
    names = ["n", *sums]
    totals = rows.groupBy(*cells.part).agg(
        F.count("*").alias("_t_n"), *[F.sum(c).alias(f"_t_{c}") for c in sums]
    )
    by_cell = totals
    if cells.tied:
        by_cell = totals.groupBy(*cells.key, "_cell").agg(*[F.sum(f"_t_{c}").alias(f"_t_{c}") for c in names])
    # the windows run over these small tables of totals, not over rows
    before = Window.partitionBy(*cells.key).orderBy("_cell").rowsBetween(*_ALL_BEFORE)
    out = by_cell.select(
        *cells.key, "_cell", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_before_{c}") for c in names]
    )
    if not cells.tied:
        return out
    inner = Window.partitionBy(*cells.key, "_cell").orderBy("_sub").rowsBetween(*_ALL_BEFORE)
    subs = totals.select(
        *cells.part, *[F.coalesce(F.sum(f"_t_{c}").over(inner), F.lit(0)).alias(f"_inner_{c}") for c in names]
    )
    joined = subs.join(out, [*cells.key, "_cell"])
    return joined.select(
        *cells.part, *[(F.col(f"_before_{c}") + F.col(f"_inner_{c}")).alias(f"_before_{c}") for c in names]
    )


def with_offsets(ranked: DataFrame, rows: DataFrame, cells: Cells, sums: Sequence[str]) -> DataFrame:
    """Join offsets by part, by which the ranked rows are partitioned already."""
    return ranked.join(part_offsets(rows, cells, sums), cells.part)


def ordered_prefix(
    df: DataFrame,
    score: str,
    id: str,
    keys: Sequence[str] = (),
    sums: Sequence[str] = (),
    descending: bool = True,
    rank_col: str = "row_num",
    nulls: str = "error",
) -> DataFrame:
    """Add the 0-based rank and the running totals ``cum_<sum>``, per key.

    The input is read several times; hand in stored rows, not a long plan.
    """
    rows = prepared(df, score, id, keys, descending, nulls)
    cells = plan_cells(rows, descending)
    rows = assign_cells(rows, cells)
    inside = inside_order(cells, rows.columns)
    ranked = rows.withColumns(
        {
            "_in": F.row_number().over(inside),
            **{f"_in_{c}": F.sum(c).over(inside.rowsBetween(*_FIRST_TO_HERE)) for c in sums},
        }
    )
    placed = with_offsets(ranked, rows, cells, sums)
    return placed.select(
        *df.columns,
        (F.col("_before_n") + F.col("_in") - 1).alias(rank_col),
        *[(F.col(f"_before_{c}") + F.col(f"_in_{c}")).alias(f"cum_{c}") for c in sums],
    )


def cumulative_at(
    df: DataFrame,
    score: str,
    id: str | None,
    cuts: str,
    keys: Sequence[str] = (),
    measure: str | None = None,
    descending: bool = True,
    nulls: str = "error",
    empty_keys: str = "ignore",
) -> DataFrame:
    """Running total of ``measure`` and the score at chosen ranks, per key.

    ``cuts`` is SQL for an array of 1-based ranks, given the row count ``n`` of a key. The result has the keys and ``cut`` (the index
    in the array), ``rank``, ``n``, ``total``, ``cum``, ``value``.

    Cells that no cut falls into contribute by their totals, which map-side
    aggregation keeps small. Only rows of the few cells that a cut divides are
    shuffled, about ``cuts / cells`` of all rows.
    """
    if measure and id is None:
        raise ValueError("running totals need an id to order equal scores")
    if taken := sorted(_RESULT_NAMES & set(keys)):
        raise ValueError(f"rename the key columns {taken}; the result has columns of these names")
    slim = df.select(*dict.fromkeys(c for c in (*keys, score, id, measure) if c))
    slim = slim.withColumn("_m", F.expr(f"coalesce(cast(`{measure}` AS BIGINT), 0L)" if measure else "0L"))
    rows = prepared(slim, score, id, keys, descending, nulls)
    rows = rows.select("_score", "_m", *(c for c in ("_exact", "_id", "_key") if c in rows.columns))
    cells = plan_cells(rows, descending, "_m" if measure else None)
    if empty_keys == "error" and (cells.n_empty_keys or not cells.n_rows):
        raise ValueError(f"{cells.n_empty_keys} of {cells.n_keys} groups have no positive label")
    rows = assign_cells(rows, cells)
    key = cells.key
    by_key = "PARTITION BY _key" if keys else ""
    ranks = f"transform({cuts}, (r, i) -> struct(i AS cut, cast(r AS BIGINT) AS rank))"
    result = [*[f"_key.`{k}` AS `{k}`" for k in keys], "cut", "rank", "n", "total"]

    hist = rows.groupBy(*key, "_cell").agg(
        F.count("*").alias("size"),
        F.sum("_m").alias("sum"),
        F.min("_score").alias("lo"),
        F.max("_score").alias("hi"),
    )
    # windows over the counts per cell, not over rows
    to_here = f"({by_key} ORDER BY _cell ROWS UNBOUNDED PRECEDING)"
    hist = hist.selectExpr(
        "*",
        f"sum(size) OVER ({by_key}) AS n",
        f"sum(sum) OVER ({by_key}) AS total",
        f"sum(size) OVER {to_here} AS end",
        f"sum(sum) OVER {to_here} AS cum",
    )
    hits = hist.selectExpr("*", f"inline(filter({ranks}, c -> c.rank > end - size AND c.rank <= end))")
    whole = "rank = end" if measure else "(rank = end OR lo = hi)"
    found = checkpointed(
        hits.selectExpr(
            *key,
            "cut",
            "rank",
            "n",
            "total",
            "_cell",
            "0 AS _sub",
            f"{whole} AS whole",
            "rank - end + size AS rest",
            f"if({whole}, cum, cum - sum) AS cum",
            f"{'lo' if descending else 'hi'} AS value",
        )
    )
    done = found.filter("whole").selectExpr(*result, "cum", "value")
    open_cuts = found.filter("NOT whole")

    if cells.tied:
        open_cuts = _cuts_in_ties(rows, open_cuts, cells)
    inside = inside_order(cells, rows.columns)
    ranked = _rows_of(rows, open_cuts, cells.part).withColumns(
        {"_in": F.row_number().over(inside), "_in_m": F.sum("_m").over(inside.rowsBetween(*_FIRST_TO_HERE))}
    )
    picked = open_cuts.drop("value").withColumnRenamed("rest", "_in")
    at_cut = ranked.join(picked, [*cells.part, "_in"]).selectExpr(*result, "cum + _in_m AS cum", "_score AS value")
    return done.unionByName(at_cut)


def _rows_of(rows: DataFrame, cuts: DataFrame, on: list[str]) -> DataFrame:
    return rows.join(cuts.select(*on).distinct(), on, "left_semi")


def _cuts_in_ties(rows: DataFrame, cuts: DataFrame, cells: Cells) -> DataFrame:
    """Move cuts inside tied cells on to the id range they fall into."""
    tied_cuts, group = cuts.filter(_in_tie(cells)), [*cells.key, "_cell"]
    if tied_cuts.isEmpty():
        return cuts
    totals = (
        _rows_of(rows, tied_cuts, group)
        .groupBy(*group, "_sub")
        .agg(F.count("*").alias("s_size"), F.sum("_m").alias("s_sum"))
    )
    to_here = f"(PARTITION BY {', '.join(group)} ORDER BY _sub ROWS UNBOUNDED PRECEDING)"
    totals = totals.selectExpr(
        *group,
        "_sub AS s_sub",
        "s_sum",
        "s_size",
        f"sum(s_size) OVER {to_here} AS s_end",
        f"sum(s_sum) OVER {to_here} AS s_cum",
    )
    moved = (
        totals.join(tied_cuts.drop("_sub"), group)
        .filter("rest > s_end - s_size AND rest <= s_end")
        .withColumns(
            {
                "_sub": F.col("s_sub"),
                "cum": F.expr("cum + s_cum - s_sum"),
                "rest": F.expr("rest - s_end + s_size"),
            }
        )
        .select(*cuts.columns)
    )
    return cuts.filter(f"NOT {_in_tie(cells)}").unionByName(checkpointed(moved))
