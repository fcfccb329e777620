"""Gain tables: how much of the response the top of a ranking captures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasRawPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftspark.functions.columns import last_probability
from liftspark.operators.prefix import cumulative_at

# Upper edges of the bands, as shares of the ranked rows.
GAIN_EDGES = (0.01, 0.02, 0.03, 0.04, 0.05, 0.08, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
TWO_DECILES = 0.2


def _band(suffix: str, size: str, responders: str) -> list[str]:
    """SQL of one band's columns; shares of nothing are null."""

    def rounded(value: str) -> str:
        return f"cast(floor({value} * 1e4D + 0.5D) AS DOUBLE) / 1e4D"

    gain = f"try_divide(cast({responders} AS DOUBLE), total)"
    return [
        f"{size} AS size_{suffix}",
        f"{responders} AS resp_num_{suffix}",
        f"{rounded(f'try_divide(cast({responders} AS DOUBLE), {size})')} AS resp_rate_{suffix}",
        f"{rounded(gain)} AS gain_{suffix}",
        f"{rounded(f'{gain} * try_divide(cast(n AS DOUBLE), {size})')} AS lift_{suffix}",
    ]


def gain_table(
    df: DataFrame,
    score: str = "score",
    label: str = "final_response",
    id: str = "jobid",
    keys: Sequence[str] = (),
    edges: Sequence[float] = GAIN_EDGES,
    no_responders: str = "error",
    nulls: str = "error",
) -> DataFrame:
    """Size, responders, rate, gain and lift per band, and from the top down to it.

    Rows rank by descending score, then by id, within each combination of
    ``keys``. A band without rows has null rate and lift. A group without any
    responder is an error unless ``no_responders="null"``, which leaves its
    gains and lifts null.
    """
    edges = [float(e) for e in edges]
    if edges != sorted(set(edges)) or not 0 < edges[0] <= edges[-1] <= 1:
        raise ValueError("edges must increase within (0, 1]")
    shares = f"array({', '.join(f'{e!r}D' for e in edges)})"
    at = cumulative_at(
        df,
        score,
        id,
        # the ranks below edge * n are the first ceil(edge * n) rows
        f"transform({shares}, e -> ceil(e * cast(n AS DOUBLE)))",
        keys,
        label,
        nulls=nulls,
        empty_keys="error" if no_responders == "error" else "ignore",
    )
    return bands(at, edges, keys)


def bands(at: DataFrame, edges: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """The gain table of running totals at the edges: ``keys, cut`` (the edge's index), ``rank, n, total, cum``."""
    shares = f"array({', '.join(f'{float(e)!r}D' for e in edges)})"
    names = [f"`{k}`" for k in keys]
    by_key = f"PARTITION BY {', '.join(names)}" if keys else ""
    before = f"OVER ({by_key} ORDER BY cut)"  # one row per edge
    steps = at.selectExpr(
        "*",
        f"element_at({shares}, cut + 1) AS group",
        f"rank - lag(rank, 1, 0L) {before} AS size",
        f"cum - lag(cum, 1, 0L) {before} AS responders",
    )
    return steps.selectExpr(
        *names, "group", *_band("grp", "size", "responders"), *_band("cum", "rank", "cum")
    )


def cumulative_gain(
    df: DataFrame,
    score: str = "score",
    label: str = "final_response",
    id: str = "jobid",
    keys: Sequence[str] = (),
    depth: float = TWO_DECILES,
    **options,
) -> DataFrame:
    """The share of all responders in the top ``depth`` of the ranking."""
    table = gain_table(df, score, label, id, keys, edges=[depth], **options)
    return table.select(*keys, F.col("gain_cum").alias("cg2d"))


class GainEvaluator(
    Evaluator, HasLabelCol, HasRawPredictionCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Cumulative gain at a depth, for use in cross-validation and tuning."""

    idCol: Param[str] = Param(
        Params._dummy(), "idCol", "unique column that orders equal scores", TypeConverters.toString
    )
    depth: Param[float] = Param(
        Params._dummy(), "depth", "share of the rows counted from the top", TypeConverters.toFloat
    )

    @keyword_only
    def __init__(self, *, rawPredictionCol="rawPrediction", labelCol="label", idCol="id", depth=TWO_DECILES):
        super().__init__()
        self._setDefault(depth=TWO_DECILES, idCol="id")
        self._set(**self._input_kwargs)

    def setRawPredictionCol(self, value: str) -> "GainEvaluator":
        return self._set(rawPredictionCol=value)

    def setLabelCol(self, value: str) -> "GainEvaluator":
        return self._set(labelCol=value)

    def setIdCol(self, value: str) -> "GainEvaluator":
        return self._set(idCol=value)

    def setDepth(self, value: float) -> "GainEvaluator":
        return self._set(depth=value)

    def getMetricName(self) -> str:
        return "CG2D"

    def isLargerBetter(self) -> bool:
        return True

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = dataset.select(
            F.col(self.getOrDefault(self.idCol)).alias("id"),
            F.col(self.getLabelCol()).cast("int").alias("label"),
            last_probability(dataset, self.getRawPredictionCol()).alias("score"),
        )
        # three narrow columns, so that the model scores every row only once
        scored = scored.persist()
        try:
            depth = self.getOrDefault(self.depth)
            return cumulative_gain(scored, "score", "label", "id", depth=depth).first()["cg2d"]
        finally:
            scored.unpersist()

    def evaluate_all(self, dataset: DataFrame, models: Sequence[Model]) -> list[float]:
        """``evaluate`` of the rows as each model scores them. The rankings share their jobs, whose number is that of one ranking."""
        rows, scores = dataset, []
        for i, model in enumerate(models):
            predicted = model.transform(rows)
            scores.append(f"_score_{i}")
            rows = predicted.select(*rows.columns, last_probability(predicted, self.getOrDefault(self.rawPredictionCol)).alias(scores[-1]))
        wide = rows.select(
            F.col(self.getOrDefault(self.idCol)).alias("id"), F.col(self.getLabelCol()).cast("int").alias("label"), F.array(*scores).alias("scores")
        ).persist()
        try:
            each = wide.select("id", "label", F.posexplode("scores").alias("model", "score"))
            found = cumulative_gain(each, "score", "label", "id", ["model"], depth=self.getOrDefault(self.depth)).collect()
        finally:
            wide.unpersist()
        return [r["cg2d"] for r in sorted(found, key=lambda r: r["model"])]
