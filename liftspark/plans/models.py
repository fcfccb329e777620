"""Training, tuning and prediction queries.

Model scores differ between engines, so queries that return them have no equivalent SQL. Beside each
stands one on the same estimator whose answer is known: rates that a converged or fully grown model must
reproduce, and what a search has to report.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from liftspark.functions.columns import last_probability, round_half_up
from liftspark.operators import curves, models, tuning
from liftspark.operators.features import INDEX_SUFFIX, TrainingSet, vector_names
from liftspark.operators.gain import cumulative_gain
from liftspark.operators.sampling import balanced_sample, hash_split
from liftspark.plans.features import gold_pipeline
from liftspark.plans.registry import query
from liftspark.plans.sampling import bucket_sql
from liftspark.plans.tables import JOBS_SQL, TRAIN_END, is_train, jobs, r4, table
from liftspark.session import checkpointed, dealt

FEATURE_NAMES = ["region", "competitor_name", "competitor_price", "dtv_flag"]


#: Rows of a partition that models train on: a forest of 100 trees caches some 500 bytes for each.
TRAIN_ROWS = 250_000


def for_training(df):
    """Rows as tasks are to hold them in training, in an order that reruns repeat."""
    return dealt(df, "jobid", rows=TRAIN_ROWS, least=df.sparkSession.sparkContext.defaultParallelism).sortWithinPartitions("jobid")


def gold(spark, sf_dir):
    """The feature table as stored for training: train and test rows."""
    fitted, df = gold_pipeline(spark, sf_dir)
    kept = fitted.transform(df).select("jobid", "final_response", "normalized", is_train().alias("is_train"))
    stored = checkpointed(kept)
    return for_training(stored.filter("is_train").drop("is_train")), stored.filter("not is_train").drop("is_train")


def evaluated(spark, name, model, test):
    """Cumulative gain and AUC of a model on the test rows, as one row."""
    predicted = model.transform(test)
    scored = predicted.select("jobid", "final_response", last_probability(predicted, "predict_prob").alias("score"))
    stored = checkpointed(scored)  # so that the model runs once per row
    gain = cumulative_gain(stored).first()["cg2d"]
    area = curves.auc(stored, "score", "final_response")
    return area.select(
        F.lit(name).alias("method"),
        F.lit(stored.count()).alias("n_test"),
        F.lit(gain).alias("cg2d"),
        round_half_up("auc").alias("auc"),
    )


def _fit(method):
    def run(spark, sf_dir):
        train, test = gold(spark, sf_dir)
        estimator, _ = models.classifier(method, "normalized")
        return evaluated(spark, method, estimator.fit(train), test)

    return run


fit_rf = query("fit_rf")(_fit("RF"))
fit_svm = query("fit_svm")(_fit("SVM"))
fit_lr = query("fit_lr")(_fit("LR"))
fit_gbt = query("fit_gbt")(_fit("GBT"))


def grouped_jobs(spark, sf_dir):
    """Indicators of region and flag as features, so that a model can tell every group apart."""
    rows = jobs(spark, sf_dir).select("jobid", "region", "dtv_flag", F.col("final_response").cast("int").alias("final_response"))
    names = [*REGIONS[1:], *FLAGS[1:]]
    flags = [(F.col("region") == r).cast("double").alias(r) for r in REGIONS[1:]] + [(F.col("dtv_flag") == f).cast("double").alias(f) for f in FLAGS[1:]]
    ready = VectorAssembler(inputCols=names, outputCol="features").transform(rows.select("*", *flags))
    return checkpointed(ready.select("jobid", "region", "dtv_flag", "final_response", "features"))


# categories of the fixture
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
FLAGS = ["No", "Unknown", "Yes"]
GROUP_RATES_SQL = f"""WITH {JOBS_SQL} SELECT region, dtv_flag, count(*) AS n, {r4('avg(final_response::DOUBLE)', 6)} AS rate
    FROM jobs GROUP BY ALL"""


def _rates(scored, rate, keys=("region", "dtv_flag")):
    return scored.groupBy(*keys).agg(F.count("*").alias("n"), round_half_up(F.avg(rate), 6).alias("rate"))


@query(
    "fit_lr_rates",
    f"WITH {JOBS_SQL} SELECT region, count(*) AS n, {r4('avg(final_response::DOUBLE)')} AS rate FROM jobs GROUP BY 1",
)
def fit_lr_rates(spark, sf_dir):
    """Without penalty and at convergence, the mean probability of a category is its observed rate."""
    rows = grouped_jobs(spark, sf_dir)
    estimator, _ = models.classifier("LR", "features")
    free = {estimator.regParam: 0.0, estimator.elasticNetParam: 0.0, estimator.maxIter: 500, estimator.tol: 1e-14}
    predicted = estimator.fit(rows, free).transform(rows)
    scored = predicted.withColumn("p", last_probability(predicted, "predict_prob"))
    return scored.groupBy("region").agg(F.count("*").alias("n"), round_half_up(F.avg("p")).alias("rate"))


@query("fit_rf_rates", f"WITH {JOBS_SQL} SELECT count(*) AS n, {r4('avg(final_response::DOUBLE)', 6)} AS rate FROM jobs")
def fit_rf_rates(spark, sf_dir):
    """One unsampled tree: its leaves, merged where they predict one class, have the rates of their rows."""
    rows = grouped_jobs(spark, sf_dir)
    estimator, _ = models.classifier("RF", "features")
    whole = {estimator.numTrees: 1, estimator.maxDepth: 12, estimator.bootstrap: False, estimator.featureSubsetStrategy: "all"}
    predicted = estimator.fit(rows, whole).transform(rows)
    return _rates(predicted.withColumn("p", last_probability(predicted, "predict_prob")), F.col("p"), ())


@query("fit_gbt_rates", GROUP_RATES_SQL)
def fit_gbt_rates(spark, sf_dir):
    """The first round of boosting fits labels of -1 and 1: a leaf's margin is twice its rate less 1."""
    rows = grouped_jobs(spark, sf_dir)
    estimator, _ = models.classifier("GBT", "features")
    predicted = estimator.fit(rows, {estimator.maxIter: 1, estimator.maxDepth: 12}).transform(rows)
    return _rates(predicted, (vector_to_array("predict_raw")[1] + 1) / 2)


@query("fit_svm_separable", f"WITH {JOBS_SQL} SELECT count(*) AS n, 0::BIGINT AS errors FROM jobs")
def fit_svm_separable(spark, sf_dir):
    """A label that one indicator decides is learned without error."""
    rows = grouped_jobs(spark, sf_dir).withColumn("final_response", (F.col("dtv_flag") == "Yes").cast("int"))
    estimator, _ = models.classifier("SVM", "features")
    predicted = estimator.fit(rows).transform(rows)
    return predicted.agg(F.count("*").alias("n"), F.count_if(F.col("predict_int") != F.col("final_response")).alias("errors"))


@query("feature_importance")
def feature_importance(spark, sf_dir):
    fitted, df = gold_pipeline(spark, sf_dir)
    # the scaler keeps the order of the elements, and the assembler their names
    ready = fitted.transform(df)
    names = [n.removesuffix(INDEX_SUFFIX) for n in vector_names(ready)]
    train = checkpointed(ready.filter(is_train()).select("jobid", "final_response", "normalized"))
    estimator, _ = models.classifier("RF", "normalized")
    found = models.feature_importance(estimator.fit(for_training(train)), names, train, top=15)
    return found.withColumn("importance", round_half_up("importance"))


@query("fit_auto")
def fit_auto(spark, sf_dir):
    """Classification and regression from a config, with the metrics of the task."""
    df = checkpointed(jobs(spark, sf_dir).drop("assignment_start_dt", "assignment_start_month").hint("rebalance"))
    config = TrainingSet("jobid", "final_response", "classification")
    train, test = hash_split(df, "jobid", [0.9, 0.1])
    model = models.train_auto(train, config)
    found = models.evaluate_auto(model.predict(test), config)
    return found.select(*[round_half_up(c).alias(c) for c in found.columns])


TEST_SIDE = bucket_sql("split", id="jobid") + " >= 9000"


def _auto_sides(spark, sf_dir, hash_fn="md5"):
    df = checkpointed(jobs(spark, sf_dir).drop("assignment_start_dt", "assignment_start_month").hint("rebalance"))
    return hash_split(df, "jobid", [0.9, 0.1], hash_fn)


@query(
    "auto_propensity",
    f"WITH {JOBS_SQL} SELECT count(*) AS n_test, true AS are_probabilities, true AS better_than_even FROM jobs WHERE {TEST_SIDE}",
)
def auto_propensity(spark, sf_dir):
    """A propensity task predicts probabilities, judged by the log-loss."""
    train, test = _auto_sides(spark, sf_dir)
    config = TrainingSet("jobid", "final_response", "propensity")
    predicted = checkpointed(models.train_auto(train, config).predict(test))
    loss = models.evaluate_auto(predicted, config).first()[0]
    return predicted.agg(
        F.count("*").alias("n_test"),
        F.bool_and(F.col("prediction").between(0, 1)).alias("are_probabilities"),
        F.lit(loss < 0.6932).alias("better_than_even"),
    )


@query(
    "auto_multiclass",
    f"""WITH {JOBS_SQL} SELECT count(*) AS n_test, true AS are_classes, true AS scores_agree FROM jobs WHERE {TEST_SIDE}""",
)
def auto_multiclass(spark, sf_dir):
    """A multiclass task predicts one of the classes; its micro-averaged scores are one number."""
    train, test = (
        side.withColumn("class", F.array_position(F.array(*map(F.lit, REGIONS)), F.col("region")) - 1).drop("region", "final_response")
        for side in _auto_sides(spark, sf_dir)
    )
    config = TrainingSet("jobid", "class", "multiclassClassification")
    predicted = checkpointed(models.train_auto(train, config).predict(test))
    scores = models.evaluate_auto(predicted, config).first()
    return predicted.agg(
        F.count("*").alias("n_test"),
        F.bool_and(F.col("prediction").isin(*range(len(REGIONS)))).alias("are_classes"),
        F.lit(len(set(scores)) == 1).alias("scores_agree"),
    )


@query("fit_auto_regression")
def fit_auto_regression(spark, sf_dir):
    """A regression with a date field becomes a time-series task with date parts."""
    li = table(spark, sf_dir, "lineitem").withColumn("row_id", F.xxhash64("l_orderkey", "l_linenumber", "l_partkey"))
    df = checkpointed(li.select("row_id", "l_quantity", "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_extendedprice"))
    config = TrainingSet("row_id", "l_extendedprice", "regression", date_field="l_shipdate")
    train, test = hash_split(df, "row_id", [0.9, 0.1])
    model = models.train_auto(train, config)
    found = models.evaluate_auto(model.predict(test), config)
    return found.select(round_half_up("mse", 2).alias("mse"), round_half_up("r2").alias("r2"))


@query("cv_grid")
def cv_grid(spark, sf_dir):
    train, _ = gold(spark, sf_dir)
    estimator, grid = models.classifier("LR", "normalized", grid=True)
    found, _ = tuning.grid_search(train, estimator, grid, models.evaluator(), "jobid", folds=2, parallelism=8)
    return found


@query("tvs")
def tvs(spark, sf_dir):
    """The random forest on a balanced sample, judged on a tenth of it."""
    train, _ = gold(spark, sf_dir)
    balanced = balanced_sample(train, "final_response", "jobid", max_imbalance=5.0)
    estimator, grid = models.classifier("RF", "normalized")
    found, _ = tuning.validation_split(balanced, estimator, grid, models.evaluator(), "jobid")
    return found


def _search_report(found, best):
    """What every search has to report, whatever its scores: trials, distinct maps, and whether the best is the first of the largest."""
    rows = found.orderBy("trial").collect()
    chosen = tuning.best_index([r["score"] for r in rows])
    label = tuning.label_of(best)
    return found.agg(
        F.count("*").alias("n_trials"),
        F.count_distinct("params").alias("n_maps"),
        F.min("trial").alias("first_trial"),
        F.max("trial").alias("last_trial"),
        (F.max(F.when(F.col("params") == label, F.col("trial"))) == chosen).alias("best_is_first_of_largest"),
    )


def _search_sql(trials: int) -> str:
    return f"SELECT {trials}::BIGINT AS n_trials, {trials}::BIGINT AS n_maps, 0 AS first_trial, {trials - 1} AS last_trial, true AS best_is_first_of_largest"


@query("cv_report", _search_sql(3))
def cv_report(spark, sf_dir):
    """The penalties of the linear SVM on three folds."""
    train, _ = gold(spark, sf_dir)
    estimator, _ = models.classifier("SVM", "normalized")
    grid = models.param_grid(estimator, {"regParam": models.CHOICES["SVM"]["regParam"]})
    found, best = tuning.grid_search(train, estimator, grid, models.evaluator(), "jobid", folds=3, parallelism=8)
    return _search_report(found, best)


@query("random_search_report", _search_sql(4))
def random_search_report(spark, sf_dir):
    train, _ = gold(spark, sf_dir)
    estimator, grid = models.classifier("LR", "normalized", grid=True)
    found, best = tuning.random_search(train, estimator, grid, models.evaluator(), "jobid", max_evals=4, folds=2)
    return _search_report(found, best)


@query("refit_best", f"WITH {JOBS_SQL} SELECT count(*) AS n, 2::BIGINT AS n_classes FROM jobs WHERE assignment_start_dt >= DATE '{TRAIN_END}'")
def refit_best(spark, sf_dir):
    """Search, refit with the pick on all training rows, and score the test rows."""
    train, test = gold(spark, sf_dir)
    estimator, grid = models.classifier("LR", "normalized", grid=True)
    _, best = tuning.random_search(train, estimator, grid, models.evaluator(), "jobid", max_evals=2, folds=2)
    predicted = tuning.refit(train, estimator, best).transform(test)
    return predicted.agg(F.count("*").alias("n"), F.lit(2).cast("long").alias("n_classes"))


@query("importance_total", "SELECT 4::BIGINT AS n_features, 1.0::DOUBLE AS total")
def importance_total(spark, sf_dir):
    """Importances are shares: all features together have 1."""
    train, _ = gold(spark, sf_dir)
    estimator, _ = models.classifier("RF", "normalized")
    found = models.feature_importance(estimator.fit(train), FEATURE_NAMES, train, top=15)
    return found.agg(F.count("*").alias("n_features"), F.round(F.sum("importance"), 9).alias("total"))


@query("random_search")
def random_search(spark, sf_dir):
    train, _ = gold(spark, sf_dir)
    estimator, grid = models.classifier("LR", "normalized", grid=True)
    found, _ = tuning.random_search(train, estimator, grid, models.evaluator(), "jobid", max_evals=4, folds=2)
    return found


@query("retrain_all")
def retrain_all(spark, sf_dir):
    """Train the methods on all training rows; report effective parameters and gain."""
    train, test = gold(spark, sf_dir)
    out = None
    for method in ("LR", "RF", "SVM", "GBT"):
        estimator, grid = models.classifier(method, "normalized")
        model = tuning.refit(train, estimator, grid[0])
        row = evaluated(spark, method, model, test).withColumn("params", F.lit(str(models.params_of(grid, model))))
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "train_test_sizes",
    f"SELECT count(*) FILTER (o_orderdate < DATE '{TRAIN_END}') AS n_train, count(*) FILTER (o_orderdate >= DATE '{TRAIN_END}') AS n_test FROM orders",
)
def train_test_sizes(spark, sf_dir):
    return jobs(spark, sf_dir).agg(
        F.count_if(is_train()).alias("n_train"), F.count_if(~is_train()).alias("n_test")
    )
