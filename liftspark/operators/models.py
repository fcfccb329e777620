"""Classifiers, regressors and the config-driven train and predict step."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator, RankingEvaluator
from pyspark.ml.param import Params
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from liftspark.functions.columns import scrub_prediction
from liftspark.operators import metrics
from liftspark.operators.boosting import Boosted, Settings, fit_boosted
from liftspark.operators.curves import AveragePrecisionEvaluator
from liftspark.operators.features import AutoFeatures, TrainingSet
from liftspark.operators.gain import GainEvaluator

PREDICT_TEMPLATE = "predict_{base}"
METHODS = ("RF", "SVM", "LR", "GBT")

# Settings of each method, and the choices a grid search covers.
SETTINGS = {
    "RF": {"numTrees": 100, "maxDepth": 5, "maxBins": 32},
    "SVM": {"maxIter": 15, "regParam": 0.1},
    "LR": {"maxIter": 15, "regParam": 0.001, "elasticNetParam": 0.75, "tol": 1e-8},
    "GBT": {"maxIter": 15, "maxDepth": 2},
}
CHOICES = {
    "RF": {"numTrees": [20, 50, 100], "maxDepth": [5, 10, 20], "maxBins": [16, 32, 64]},
    "SVM": {"maxIter": [10, 15, 20], "regParam": [0.001, 0.01, 0.1]},
    "LR": {
        "maxIter": [10, 15],
        "tol": [1e-6, 1e-8],
        "regParam": [0.001, 0.01, 0.1, 0.3],
        "elasticNetParam": [0.8, 0.75],
    },
    "GBT": {"maxIter": [15], "maxDepth": [2]},
}
EXPERT = {"stepSize": 0.01, "maxIter": 650, "maxDepth": 8}


def predict_col(base: str) -> str:
    return PREDICT_TEMPLATE.format(base=base)


def classifier(
    method: str, features: str, label: str = "final_response", grid: bool = False, seed: int = 42
) -> tuple[Estimator, list[dict]]:
    """An untrained classifier and the parameter maps to search.

    Without ``grid`` there is one map, with the settings of the method. The
    linear SVM has no probabilities; its raw scores take that column.
    """
    cols = {"featuresCol": features, "labelCol": label, "predictionCol": predict_col("int")}
    raw = {"rawPredictionCol": predict_col("raw"), "probabilityCol": predict_col("prob")}
    settings = SETTINGS[method]
    if method == "RF":
        estimator = RandomForestClassifier(**cols, **raw, **settings, seed=seed)
    elif method == "SVM":
        estimator = LinearSVC(**cols, rawPredictionCol=predict_col("prob"), **settings)
    elif method == "LR":
        estimator = LogisticRegression(**cols, **raw, **settings, family="multinomial")
    else:
        estimator = _boosted(GBTClassifier(**cols, **settings, seed=seed))
    choices = CHOICES[method] if grid else {k: [v] for k, v in settings.items()}
    return estimator, param_grid(estimator, choices)


def expert_classifier(
    features: str, label: str = "final_response", seed: int = 42, **settings
) -> GBTClassifier:
    """Many small boosting steps on deeper trees; trees grow level by level."""
    cols = {"featuresCol": features, "labelCol": label, "predictionCol": predict_col("int")}
    return _boosted(GBTClassifier(**cols, seed=seed, **{**EXPERT, **settings}))


def _boosted(estimator: GBTClassifier) -> GBTClassifier:
    """Name the score columns, which this class takes by setter only."""
    return estimator.setRawPredictionCol(predict_col("raw")).setProbabilityCol(predict_col("prob"))


def param_grid(estimator: Params, choices: dict[str, Sequence]) -> list[dict]:
    builder = ParamGridBuilder()
    for name, values in choices.items():
        builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


def grid_choices(grid: Sequence[dict]) -> dict[str, list]:
    """The distinct choices per parameter, in order of appearance."""
    out: dict[str, list] = {}
    for point in grid:
        for param, value in point.items():
            known = out.setdefault(param.name, [])
            if value not in known:
                known.append(value)
    return out


def params_of(grid: Sequence[dict], model: Params) -> dict:
    """Effective values, in a model, of the parameters a grid covers."""
    return {name: model.getOrDefault(name) for name in grid_choices(grid)}


def evaluator(kind: str = "CG2D", label: str = "final_response", id: str = "jobid", query: str | None = None) -> Evaluator:
    """``"mAP"``, ``"AUC"`` (of the hard class) or the cumulative gain.

    With ``query`` the mean average precision is that of a classifier's scores, rows being ranked within each value of that
    column, so that it can steer a search; without, of predicted and true lists.
    """
    if kind == "mAP" and query:
        return AveragePrecisionEvaluator(rawPredictionCol=predict_col("prob"), labelCol=label, idCol=id, queryCol=query)
    if kind == "mAP":
        return RankingEvaluator(
            predictionCol=predict_col("score"), labelCol=predict_col("label"), metricName="meanAveragePrecision", k=100
        )
    if kind == "AUC":
        return BinaryClassificationEvaluator(
            rawPredictionCol=predict_col("int"), labelCol=label, metricName="areaUnderROC"
        )
    return GainEvaluator(rawPredictionCol=predict_col("prob"), labelCol=label, idCol=id)


def feature_importance(model: Model, names: Sequence[str], like: DataFrame, top: int = 15) -> DataFrame:
    """The most important features, largest first; one row per feature at most."""
    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    found = like.sparkSession.createDataFrame(rows, "feature string, importance double")
    return found.orderBy(F.col("importance").desc(), "feature").limit(top)


@dataclass(frozen=True)
class AutoModel:
    """A fitted chain of automatic features and boosted trees."""

    features: AutoFeatures
    model: Boosted

    def predict(self, df: DataFrame) -> DataFrame:
        """Id, target if known, ``prediction`` and, for classes, the probability."""
        cfg = self.features.config
        scored = self.model.transform(self.features.transform(df))
        own = [c for c in (cfg.row_id, cfg.target) if c in df.columns]
        if cfg.kind in ("classification", "propensity"):
            scored = scored.withColumn(cfg.probability_col, F.element_at("probability", 2))
            own.append(cfg.probability_col)
        value = scrub_prediction(cfg.kind, "prediction", cfg.probability_col)
        return scored.select(*own, value.alias("prediction"))

    def importance(self, like: DataFrame, top: int = 15) -> DataFrame:
        """The features that most splits use, as shares of all splits."""
        rows = list(zip(self.features.columns, self.model.split_shares().tolist()))
        found = like.sparkSession.createDataFrame(rows, "feature string, importance double")
        return found.orderBy(F.col("importance").desc(), "feature").limit(top)


def train_auto(df: DataFrame, config: TrainingSet, **settings) -> AutoModel:
    """Fit features and leaf-wise boosted trees for the task of the config; ``settings`` as in ``boosting.Settings``.

    Targets of classes are 0 and 1, or 0 to the number of classes less 1.
    """
    features = AutoFeatures(config).fit(df)
    ready = features.transform(df)
    if isinstance(ready.schema[config.target].dataType, T.StringType):
        raise TypeError("index a text target before training")
    objective, classes = "logistic", 0
    if config.kind in ("regression", "time_series"):
        objective = "squared"
    elif config.kind == "multiclassClassification":
        # two classes at least, as softmax needs them
        objective, classes = "softmax", max(2, int(ready.agg(F.max(config.target)).first()[0]) + 1)
    return AutoModel(features, fit_boosted(ready, features.columns, config.target, objective, Settings(**settings), classes))


def evaluate_auto(predicted: DataFrame, config: TrainingSet) -> DataFrame:
    """The metrics that belong to the task."""
    if config.kind == "classification":
        return metrics.binary_metrics(predicted, config.target, "prediction")
    if config.kind == "propensity":
        return metrics.log_loss(predicted, config.target, "prediction")
    if config.kind == "multiclassClassification":
        return metrics.multiclass_metrics(predicted, config.target, "prediction")
    return metrics.regression_metrics(predicted, config.target, "prediction")
