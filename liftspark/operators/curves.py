"""ROC, precision-recall and detection-error curves, AUC, ranking precision.

Equal scores are one threshold, so rows shrink to counts per score before
anything is ordered; a heavily tied score costs one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasRawPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from liftspark.functions.columns import last_probability
from liftspark.operators.prefix import (
    Cells,
    assign_cells,
    inside_order,
    ordered_prefix,
    plan_cells,
    prepared,
    with_offsets,
)
from liftspark.session import checkpointed

_BIG = "decimal(38,0)"


def threshold_counts(
    df: DataFrame, score: str, label: str, keys: Sequence[str] = (), nulls: str = "error", next_counts: bool = False
) -> tuple[DataFrame, Cells]:
    """Counts per distinct score: ``pos``, ``neg``, and ``tp``, ``fp`` at or above it. A null label is an error.

    With ``next_counts`` also ``next_pos``, ``next_neg`` of the next smaller score, null for the last.
    """
    slim = df.select(*dict.fromkeys([*keys, score, label]))
    missing = F.raise_error(F.lit(f"column {label!r} has null labels"))
    is_pos = F.when(F.col(label).isNull(), missing).otherwise((F.col(label) == 1).cast("bigint")).cast("bigint")
    rows = prepared(slim.withColumns({"_pos": is_pos, "_neg": 1 - is_pos}), score, None, keys, nulls=nulls)
    cells = plan_cells(rows, measure="_pos")
    if cells.n_empty_keys or not cells.n_rows:
        raise ValueError(f"{cells.n_empty_keys} of {cells.n_keys} groups have no positive label")
    rows = assign_cells(rows, cells)
    counts = rows.groupBy(*cells.part, "_score").agg(F.sum("_pos").alias("pos"), F.sum("_neg").alias("neg"))
    inside = inside_order(cells, counts.columns)
    ranked = counts.withColumns({"_in_pos": F.sum("pos").over(inside), "_in_neg": F.sum("neg").over(inside)})
    if next_counts:
        ranked = _with_next(ranked, counts, cells)
    # offsets come from the rows, aggregated map-side, so that the counts per
    # score are shuffled for one use only
    placed = with_offsets(ranked, rows, cells, ["_pos", "_neg"])
    out = placed.select(
        *[F.col(f"_key.{k}").alias(k) for k in keys],
        F.col("_score").alias("threshold"),
        "pos",
        "neg",
        (F.col("_before__pos") + F.col("_in_pos")).alias("tp"),
        (F.col("_before__neg") + F.col("_in_neg")).alias("fp"),
        *(["next_pos", "next_neg"] if next_counts else []),
    )
    return out, cells


def _with_next(ranked: DataFrame, counts: DataFrame, cells: Cells) -> DataFrame:
    """Add the counts of the next smaller score: within the cell, or the first of the next cell."""
    first = counts.groupBy(*cells.part).agg(F.max(F.struct("_score", "pos", "neg")).alias("_first"))
    # a window over one row per cell
    after = Window.partitionBy(*cells.key).orderBy("_cell")
    first = first.select(*cells.part, F.lead("_first").over(after).alias("_after"))
    inside = inside_order(cells, counts.columns)
    here = ranked.withColumns({f"_next_{c}": F.lead(c).over(inside) for c in ("pos", "neg")})
    return here.join(first, cells.part).withColumns(
        {f"next_{c}": F.coalesce(F.col(f"_next_{c}"), F.col(f"_after.{c}")) for c in ("pos", "neg")}
    )


def class_totals(df: DataFrame, label: str, keys: Sequence[str] = ()) -> DataFrame:
    is_pos = F.coalesce(F.col(label), F.lit(0)) == 1
    return df.groupBy(*keys).agg(F.count_if(is_pos).alias("n_pos"), F.count_if(~is_pos).alias("n_neg"))


def _per_key(points: DataFrame, values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the one row of ``values`` that belongs to each key."""
    names = [c for c in values.columns if c not in keys]
    if not keys:
        row = values.first()
        return points.withColumns({c: F.lit(row[c]) for c in names})
    same = [points[k].eqNullSafe(values[k]) for k in keys]
    return points.join(values, same).select(points["*"], *[values[c] for c in names])


def _share(part: str, whole: str):
    return F.try_divide(F.col(part).cast("double"), F.col(whole))


def _end_point(df: DataFrame, keys: Sequence[str], **values: float) -> DataFrame:
    """The point of each curve that belongs to no threshold."""
    groups = df.select(*keys).distinct() if keys else df.sparkSession.range(1).select()
    return groups.select(
        *keys, *[F.lit(v).alias(c) for c, v in values.items()], F.lit(None).cast("double").alias("threshold")
    )


def roc_curve(df: DataFrame, score: str, label: str, keys: Sequence[str] = (), drop_intermediate: bool = True) -> DataFrame:
    """``fpr``, ``tpr`` per threshold, and the point (0, 0), whose threshold is null.

    With ``drop_intermediate`` a threshold goes if the step to it equals the step from it: it lies on a
    straight line between its neighbours. The first and the last threshold stay.
    """
    points, _ = threshold_counts(df, score, label, keys, next_counts=drop_intermediate)
    if drop_intermediate:
        is_first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
        turns = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
        points = points.filter(is_first | F.col("next_pos").isNull() | turns)
    full = _per_key(points, class_totals(df, label, keys), keys)
    curve = full.select(*keys, _share("fp", "n_neg").alias("fpr"), _share("tp", "n_pos").alias("tpr"), "threshold")
    return curve.unionByName(_end_point(df, keys, fpr=0.0, tpr=0.0))


def precision_recall_curve(df: DataFrame, score: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """``precision``, ``recall`` per threshold, and the end point (1, 0)."""
    points, _ = threshold_counts(df, score, label, keys)
    full = _per_key(points, class_totals(df, label, keys), keys)
    precision = F.col("tp").cast("double") / (F.col("tp") + F.col("fp"))
    curve = full.select(*keys, precision.alias("precision"), _share("tp", "n_pos").alias("recall"), "threshold")
    return curve.unionByName(_end_point(df, keys, precision=1.0, recall=0.0))


def det_curve(df: DataFrame, score: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """``fpr``, ``fnr`` per threshold.

    The curve runs from the last threshold that still has the smallest false
    positive count to the first that misses no positive; thresholds outside
    would only repeat a rate.
    """
    points, _ = threshold_counts(df, score, label, keys)
    points = checkpointed(points)  # read twice, and costly to make
    ends = points.groupBy(*keys).agg(
        F.max("tp").alias("n_pos"),
        F.max("fp").alias("n_neg"),
        F.min(F.struct("fp", "threshold"))["threshold"].alias("begin"),
    )
    full = _per_key(points, ends, keys)
    kept = full.filter((F.col("threshold") <= F.col("begin")) & (F.col("tp") - F.col("pos") < F.col("n_pos")))
    missed = (F.col("n_pos") - F.col("tp")).cast("double") / F.col("n_pos")
    return kept.select(*keys, _share("fp", "n_neg").alias("fpr"), missed.alias("fnr"), "threshold")


def auc(df: DataFrame, score: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve, exact under ties.

    With ``fp`` counting the negatives at or above a score, its positives win
    ``n_neg - fp`` comparisons and tie ``neg``. All sums are integers.
    """
    points, _ = threshold_counts(df, score, label, keys)
    big = {c: F.col(c).cast(_BIG) for c in ("pos", "neg", "fp")}
    lost = (big["pos"] * (2 * big["fp"] - big["neg"]).cast("decimal(20,0)")).cast(_BIG)
    sums = points.groupBy(*keys).agg(
        F.sum("pos").alias("p"), F.sum("neg").alias("n"), F.sum(lost).cast(_BIG).alias("lost")
    )
    pairs = 2 * F.col("p").cast("decimal(18,0)") * F.col("n").cast("decimal(18,0)")
    won = (pairs - F.col("lost")).cast("double")
    return sums.select(*keys, F.try_divide(won, pairs.cast("double")).alias("auc"))


def mean_average_precision(df: DataFrame, query: str, item: str, score: str, relevant: str) -> DataFrame:
    """Mean over queries of the average precision of their ranked items.

    ``df`` has one row per query and item, with ``relevant`` 0 or 1. A query
    without relevant items counts as zero.
    """
    ranked = ordered_prefix(
        df.select(query, item, score, F.col(relevant).cast("bigint").alias("_rel")), score, item, [query], ["_rel"]
    )
    hit = F.when(F.col("_rel") == 1, F.col("cum__rel") / (F.col("row_num") + 1))
    per_query = ranked.groupBy(query).agg(
        F.try_divide(F.coalesce(F.sum(hit), F.lit(0.0)), F.sum("_rel")).alias("ap")
    )
    return per_query.agg(
        F.avg(F.coalesce("ap", F.lit(0.0))).alias("mean_avg_precision"), F.count("*").alias("n_queries")
    )


class AveragePrecisionEvaluator(Evaluator, HasLabelCol, HasRawPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Mean over queries of the average precision of rows ranked by score, for use in cross-validation and tuning."""

    idCol: Param[str] = Param(Params._dummy(), "idCol", "unique column that orders equal scores", TypeConverters.toString)
    queryCol: Param[str] = Param(Params._dummy(), "queryCol", "column whose values are the queries", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, rawPredictionCol="rawPrediction", labelCol="label", idCol="id", queryCol="query"):
        super().__init__()
        self._setDefault(idCol="id", queryCol="query")
        self._set(**self._input_kwargs)

    def isLargerBetter(self) -> bool:
        return True

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = dataset.select(
            F.col(self.getOrDefault(self.queryCol)).alias("query"),
            F.col(self.getOrDefault(self.idCol)).alias("item"),
            last_probability(dataset, self.getRawPredictionCol()).alias("score"),
            F.col(self.getLabelCol()).cast("int").alias("relevant"),
        )
        scored = scored.persist()  # narrow, so that the model scores every row only once
        try:
            return mean_average_precision(scored, "query", "item", "score", "relevant").first()["mean_avg_precision"]
        finally:
            scored.unpersist()
