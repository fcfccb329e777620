"""Searches over settings: grids on folds, adaptive search, refits, and the boosted trees they train."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from liftspark.functions.columns import round_half_up
from liftspark.operators import boosting, curves, ridge, runlog, segments, tuning
from liftspark.operators.gain import cumulative_gain
from liftspark.plans.models import REGIONS
from liftspark.plans.registry import query
from liftspark.plans.sampling import bucket_sql
from liftspark.plans.tables import JOBS_SQL, is_train, jobs, r4, table
from liftspark.session import checkpointed, scratch_path

# a ridge grid: squares of whole numbers as penalties, on each choice of two features

FEATURE_SETS = (("l_quantity",), ("l_tax",), ("l_quantity", "l_tax"))
PENALTY_STEPS, FOLDS = 60, 5


def ridge_points(steps=PENALTY_STEPS):
    return [ridge.RidgePoint(5.0 * i * i, names) for names in FEATURE_SETS for i in range(steps)]


def line_prices(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn("row_id", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    return li.select("row_id", "l_quantity", "l_tax", "l_extendedprice")


def ridge_sql(steps=PENALTY_STEPS):
    """Losses of every point on every fold. With both features the two normal equations are solved by their determinant."""
    names = {"x": "l_quantity", "z": "l_tax", "y": "l_extendedprice"}
    products = ["xx", "xz", "zz", "xy", "zy", "yy"]
    values = ", ".join(f"{column}::DOUBLE AS {name}" for name, column in names.items())
    centre = ", ".join(f"avg({name}) AS m{name}" for name in names)
    sums = ", ".join(f"sum({a} * {b}) AS s{a}{b}" for a, b in products) + ", " + ", ".join(f"sum({name}) AS s{name}" for name in names)
    rest = ", ".join(f"t.s{c} - f.s{c} AS r{c}, f.s{c}" for c in [*products, *names])
    centred = ", ".join(f"r{a}{b} - r{a} * r{b} / rn AS c{a}{b}" for a, b in products)
    return f"""li AS (SELECT l_orderkey * 8 + l_linenumber AS row_id, {values} FROM lineitem),
    mid AS (SELECT {centre} FROM li),
    shifted AS (SELECT {bucket_sql("fold", FOLDS, "row_id")}::INTEGER AS fold, x - mx AS x, z - mz AS z, y - my AS y FROM li, mid),
    f AS (SELECT fold, count(*)::DOUBLE AS n, {sums} FROM shifted GROUP BY fold),
    t AS (SELECT sum(n) AS n, {", ".join(f"sum(s{c}) AS s{c}" for c in [*products, *names])} FROM f),
    r AS (SELECT fold, f.n, t.n - f.n AS rn, {rest} FROM f, t),
    c AS (SELECT *, {centred} FROM r),
    points AS (SELECT k * {steps} + i AS trial, k, 5.0::DOUBLE * i * i AS penalty FROM range(3) a(k), range({steps}) b(i)),
    solved AS (SELECT *, CASE k WHEN 0 THEN cxy / (cxx + penalty) WHEN 1 THEN 0
          ELSE (cxy * (czz + penalty) - cxz * czy) / ((cxx + penalty) * (czz + penalty) - cxz * cxz) END AS bx,
        CASE k WHEN 0 THEN 0 WHEN 1 THEN czy / (czz + penalty)
          ELSE (czy * (cxx + penalty) - cxz * cxy) / ((cxx + penalty) * (czz + penalty) - cxz * cxz) END AS bz FROM c, points),
    placed AS (SELECT *, ry / rn - bx * rx / rn - bz * rz / rn AS b0 FROM solved),
    losses AS (SELECT trial, k, penalty, fold, (syy + bx * bx * sxx + bz * bz * szz + b0 * b0 * n - 2 * bx * sxy - 2 * bz * szy - 2 * b0 * sy
        + 2 * bx * bz * sxz + 2 * bx * b0 * sx + 2 * bz * b0 * sz) / n AS loss FROM placed)"""


@query(
    "cv_ridge",
    f"""WITH {ridge_sql()} SELECT trial::INTEGER AS trial, penalty, CASE k WHEN 2 THEN 2 ELSE 1 END AS n_features, count(*) AS folds,
      {r4('avg(loss)', 2)} AS mean_loss FROM losses GROUP BY ALL""",
)
def cv_ridge(spark, sf_dir):
    """180 points on five folds, from one aggregation of the rows."""
    points = ridge_points()
    scores = ridge.cross_validate(line_prices(spark, sf_dir), "l_extendedprice", "row_id", points, FOLDS, "md5")
    about = spark.createDataFrame([(i, p.penalty, len(p.features)) for i, p in enumerate(points)], "trial int, penalty double, n_features int")
    found = scores.groupBy("trial").agg(F.count("*").alias("folds"), round_half_up(F.avg("loss"), 2).alias("mean_loss"))
    return about.join(found, "trial").select("trial", "penalty", "n_features", "folds", "mean_loss")


FEW = 6
BEST_RIDGE_SQL = f"""{ridge_sql(FEW)}, means AS (SELECT trial, k, penalty, avg(loss) AS mean_loss FROM losses GROUP BY ALL),
    best AS (SELECT * FROM means ORDER BY mean_loss, trial LIMIT 1)"""


def _fold_losses(spark, sf_dir, steps):
    """The losses of all points by fold: what each trial of a search would find."""
    points = ridge_points(steps)
    scores = ridge.cross_validate(line_prices(spark, sf_dir), "l_extendedprice", "row_id", points, FOLDS, "md5")
    by_point: dict = {}
    for r in scores.orderBy("trial", "fold").collect():  # points by folds
        by_point.setdefault((points[r["trial"]].penalty, list(points[r["trial"]].features)[-1], len(points[r["trial"]].features)), []).append(r["loss"])
    return points, by_point


@query(
    "cv_results_logged",
    f"""WITH {ridge_sql(FEW)} SELECT trial::INTEGER AS trial, {r4('avg(loss)', 2)} AS mean_test_score, {r4('stddev_pop(loss)', 2)} AS std_test_score, count(*) AS folds
      FROM losses GROUP BY trial""",
)
def cv_results_logged(spark, sf_dir):
    """A search writes its scores by fold to the run log, from which the result table is read."""
    points, by_point = _fold_losses(spark, sf_dir, FEW)
    path = scratch_path(spark, "runlog")
    tuning.log_trials(spark, path, "ridge", [{"penalty": p.penalty, "features": list(p.features)} for p in points], list(by_point.values()))
    runs, kv = runlog.read_log(spark, path)
    trial = kv.filter("kind = 'tag' and key = 'trial'").select("run_id", F.col("text").cast("int").alias("trial"))
    scores = kv.filter("kind = 'metric' and key = 'score'").join(trial, "run_id")
    found = runlog.cv_results(scores, ["trial"], "value")
    return found.withColumns({c: round_half_up(c, 2) for c in ("mean_test_score", "std_test_score")})


@query(
    "adaptive_search",
    f"""WITH {BEST_RIDGE_SQL} SELECT {3 * FEW}::BIGINT AS n_trials, (SELECT count(DISTINCT trial) FROM losses) AS n_points,
      penalty AS best_penalty, CASE k WHEN 2 THEN 2 ELSE 1 END AS best_features, {r4('mean_loss', 2)} AS best_loss FROM best""",
)
def adaptive_search(spark, sf_dir):
    """Parzen search, stopped halfway and resumed from its log, until all points are tried: its best is the best."""
    _, by_point = _fold_losses(spark, sf_dir, FEW)
    choices = {"penalty": [5.0 * i * i for i in range(FEW)], "features": [list(s) for s in FEATURE_SETS]}
    path = scratch_path(spark, "runlog")

    def search(budget):
        losses = lambda p: by_point[p["penalty"], p["features"][-1], len(p["features"])]
        return tuning.adaptive_search(spark, choices, losses, path, "ridge", budget, larger_is_better=False, startup=5)

    search(FEW)
    trials, best = search(3 * FEW)
    rows = [(len(trials), len({json.dumps(p, sort_keys=True) for p, _ in trials}), best["penalty"], len(best["features"]), min(s for _, s in trials))]
    found = spark.createDataFrame(rows, "n_trials bigint, n_points bigint, best_penalty double, best_features int, best_loss double")
    return found.withColumn("best_loss", round_half_up("best_loss", 2))


@query(
    "refit_ridge",
    f"""WITH {BEST_RIDGE_SQL}, w AS (SELECT n, syy, sxx - sx * sx / n AS wxx, sxz - sx * sz / n AS wxz, szz - sz * sz / n AS wzz,
        sxy - sx * sy / n AS wxy, szy - sz * sy / n AS wzy FROM t),
      b AS (SELECT penalty, k, CASE k WHEN 0 THEN wxy / (wxx + penalty) WHEN 1 THEN 0
          ELSE (wxy * (wzz + penalty) - wxz * wzy) / ((wxx + penalty) * (wzz + penalty) - wxz * wxz) END AS bx,
        CASE k WHEN 0 THEN 0 WHEN 1 THEN wzy / (wzz + penalty)
          ELSE (wzy * (wxx + penalty) - wxz * wxy) / ((wxx + penalty) * (wzz + penalty) - wxz * wxz) END AS bz FROM w, best)
      SELECT penalty, {r4('bx')} AS slope_quantity, {r4('bz')} AS slope_tax, {r4('my - bx * mx - bz * mz')} AS intercept FROM b, mid""",
)
def refit_ridge(spark, sf_dir):
    """The best point of a grid, trained on all rows: its slopes and intercept."""
    df, points = line_prices(spark, sf_dir), ridge_points(FEW)
    scores = ridge.cross_validate(df, "l_extendedprice", "row_id", points, FOLDS, "md5")
    means = [r["loss"] for r in scores.groupBy("trial").agg(F.avg("loss").alias("loss")).orderBy("trial").collect()]
    best = points[tuning.best_index(means, larger_is_better=False)]
    whole = ridge.moments(df.withColumn("fold", F.lit(0)), [*best.features, "l_extendedprice"], "fold")[0]
    slopes, intercept = ridge.solve(whole, best.penalty)
    by_name = dict(zip(best.features, slopes.tolist()))
    row = (best.penalty, by_name.get("l_quantity", 0.0), by_name.get("l_tax", 0.0), intercept)
    found = spark.createDataFrame([row], "penalty double, slope_quantity double, slope_tax double, intercept double")
    return found.select("penalty", *[round_half_up(c).alias(c) for c in ("slope_quantity", "slope_tax", "intercept")])


# The choices of the regression grid, 180 points.
REGRESSION_CHOICES = {
    "leaves": [31, 127],
    "l1": [0.1, 0.5],
    "min_rows": [30, 50, 100, 300, 400],
    "l2": [0.0, 1.0, 1.5],
    "step": [0.1, 0.05, 0.01],
}


@query("cv_grid_regression")
def cv_grid_regression(spark, sf_dir):
    """Leaf-wise boosted trees at 180 points on five folds, all from one aggregation of the rows.

    Searched by halving: all points with 4 rounds, the best third with 12, and so on; ``rounds`` says how far a point came. Without
    ``halving`` every point gets its 100 rounds.
    """
    li = table(spark, sf_dir, "lineitem").withColumn("row_id", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    rows = li.select("row_id", "l_quantity", "l_discount", F.expr("ascii(l_returnflag)").alias("flag"), "l_extendedprice")
    grid = tuning.all_points(REGRESSION_CHOICES)
    points = [boosting.Settings(**p) for p in grid]
    scores = boosting.cross_validate(rows, ["l_quantity", "l_discount", "flag"], "l_extendedprice", "row_id", points, folds=FOLDS, halving=boosting.Halving())
    last = scores.join(scores.groupBy("trial").agg(F.max("rounds").alias("rounds")), ["trial", "rounds"])
    about = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(grid)], "trial int, params string")
    return about.join(runlog.cv_results(last, ["trial", "rounds"], "loss"), "trial")


# boosted trees whose answers are known


def _coded(df):
    """Texts as numbers in their order, null as it is."""
    names = F.array(*map(F.lit, ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]))
    flags = F.array(*map(F.lit, ["No", "Unknown", "Yes"]))
    regions = F.array(*map(F.lit, REGIONS))
    return df.withColumns({
        "name_at": F.array_position(names, F.col("competitor_name")),
        "flag_at": F.array_position(flags, F.col("dtv_flag")),
        "region_at": F.array_position(regions, F.col("region")),
    })


WHOLE = boosting.Settings(rounds=1, leaves=200, step=1.0, min_rows=1, min_hessian=0.0)


@query(
    "boosted_group_means",
    f"""WITH {JOBS_SQL} SELECT region, competitor_name, dtv_flag, count(*) AS n, {r4('sum(competitor_price)', 2)} AS total
      FROM jobs WHERE competitor_price IS NOT NULL GROUP BY ALL""",
)
def boosted_group_means(spark, sf_dir):
    """One round of full steps on a tree with a leaf for each group predicts the group's mean, so predictions add up to the prices."""
    df = _coded(jobs(spark, sf_dir)).filter("competitor_price is not null")
    rows = checkpointed(df.select("region", "competitor_name", "dtv_flag", "region_at", "name_at", "flag_at", "competitor_price"))
    model = boosting.fit_boosted(rows, ["region_at", "name_at", "flag_at"], "competitor_price", "squared", WHOLE)
    predicted = model.transform(rows).groupBy("region", "competitor_name", "dtv_flag")
    return predicted.agg(F.count("*").alias("n"), round_half_up(F.sum("prediction"), 2).alias("total"))


@query(
    "boosted_classes",
    f"""WITH {JOBS_SQL}, g AS (SELECT competitor_name, dtv_flag, count(*) AS n FROM jobs GROUP BY ALL),
      p AS (SELECT region, count(*) / (SELECT count(*) FROM jobs)::DOUBLE AS p0 FROM jobs GROUP BY region),
      c AS (SELECT competitor_name, dtv_flag, region, count(*) AS k FROM jobs GROUP BY ALL)
      SELECT g.competitor_name, g.dtv_flag, p.region, g.n, {r4('ln(p0) + (coalesce(k, 0) - g.n * p0) / (g.n * p0 * (1 - p0))', 6)} AS score
      FROM g CROSS JOIN p LEFT JOIN c ON c.region = p.region AND c.dtv_flag = g.dtv_flag AND c.competitor_name IS NOT DISTINCT FROM g.competitor_name""",
)
def boosted_classes(spark, sf_dir):
    """The first round of softmax boosting: one tree per class, whose leaves are Newton steps from the shares of the classes."""
    df = _coded(jobs(spark, sf_dir)).withColumn("class", F.col("region_at") - 1)
    rows = checkpointed(df.select("competitor_name", "dtv_flag", "name_at", "flag_at", "class"))
    model = boosting.fit_boosted(rows, ["name_at", "flag_at"], "class", "softmax", WHOLE, classes=len(REGIONS))
    # probabilities tell scores up to a sum, which the start scores of all classes with the trees' values give back
    groups = rows.groupBy("competitor_name", "dtv_flag", "name_at", "flag_at").agg(F.count("*").alias("n"))
    scored = model.with_scores(groups, "scores")
    each = scored.select("competitor_name", "dtv_flag", "n", F.posexplode("scores").alias("at", "score"))
    region = F.element_at(F.array(*map(F.lit, REGIONS)), F.col("at") + 1)
    return each.select("competitor_name", "dtv_flag", region.alias("region"), "n", round_half_up("score", 6).alias("score"))


@query("fit_expert")
def fit_expert(spark, sf_dir):
    """The expert settings in full: 650 leaf-wise trees of 31 leaves."""
    df = checkpointed(_coded(jobs(spark, sf_dir)).select("jobid", "final_response", "region_at", "name_at", "flag_at", "competitor_price", is_train().alias("is_train")))
    features = ["region_at", "name_at", "flag_at", "competitor_price"]
    model = boosting.fit_boosted(df.filter("is_train"), features, "final_response", "logistic", boosting.EXPERT)
    predicted = model.transform(df.filter("not is_train"))
    scored = checkpointed(predicted.select("jobid", "final_response", F.col("probability")[1].alias("score")))
    gain = cumulative_gain(scored).first()["cg2d"]
    area = curves.auc(scored, "score", "final_response")
    return area.select(F.lit("expert").alias("method"), F.lit(scored.count()).alias("n_test"), F.lit(gain).alias("cg2d"), round_half_up("auc").alias("auc"))


@query(
    "fit_lr_by_segment",
    f"""WITH {JOBS_SQL}, by_tag AS (SELECT region AS tag, dtv_flag, final_response FROM jobs UNION ALL SELECT 'national', dtv_flag, final_response FROM jobs)
      SELECT tag, dtv_flag, count(*) AS n, {r4('avg(final_response::DOUBLE)', 6)} AS rate FROM by_tag GROUP BY ALL""",
)
def fit_lr_by_segment(spark, sf_dir):
    """A model for each region and one for the nation, in the same jobs: with an indicator per flag each must reproduce its own rates."""
    df = jobs(spark, sf_dir).select("region", "dtv_flag", "final_response")
    both = df.withColumn("tag", F.explode(F.array("region", F.lit("national")))).drop("region")
    flags = both.withColumns({"is_unknown": (F.col("dtv_flag") == "Unknown").cast("double"), "is_yes": (F.col("dtv_flag") == "Yes").cast("double")})
    rows, features = checkpointed(flags), ["is_unknown", "is_yes"]
    model = segments.fit_logistic_by(rows, ["tag"], features, "final_response", penalty=0.0)
    scored = segments.score_by(rows, model, ["tag"], features)
    return scored.groupBy("tag", "dtv_flag").agg(F.count("*").alias("n"), round_half_up(F.avg("score"), 6).alias("rate"))
