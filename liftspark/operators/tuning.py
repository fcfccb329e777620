"""Grid search, random and adaptive search, validation splits and retraining."""

from __future__ import annotations

import heapq
import itertools
import json
import math
import random
from collections.abc import Callable, Mapping, Sequence
from multiprocessing.pool import ThreadPool
from statistics import fmean, pstdev

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import Evaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftspark.operators import runlog
from liftspark.operators.sampling import hash_split, with_fold

RESULT_SCHEMA = "trial int, params string, score double, score_std double"
#: Models whose scores of a row are held at once.
TOGETHER = 16


def label_of(point: dict) -> str:
    """A parameter map as text."""
    return json.dumps({p.name: v for p, v in sorted(point.items(), key=lambda kv: kv[0].name)})


def _result_table(like: DataFrame, grid: Sequence[dict], scores: Sequence[float], stds: Sequence[float]) -> DataFrame:
    rows = [(i, label_of(p), float(s), float(d)) for i, (p, s, d) in enumerate(zip(grid, scores, stds))]
    return like.sparkSession.createDataFrame(rows, RESULT_SCHEMA)


def best_index(scores: Sequence[float], larger_is_better: bool = True) -> int:
    """Index of the best score; the first of equals. NaN never wins over a number."""
    sign = 1 if larger_is_better else -1
    worth = [-math.inf if math.isnan(s) else sign * s for s in scores]
    return worth.index(max(worth))


def _scores(
    sides: Sequence[tuple[DataFrame, DataFrame]], estimator: Estimator, grid: Sequence[dict], evaluator: Evaluator, parallelism: int
) -> list[list[float]]:
    """Fit every map on the training side of every pair and score it on the other: by pair, then by map.

    All pairs and maps form one queue, so that the end of a fold leaves no core idle. Sides are read once per
    fit, so they are cached for the duration. Maps that differ only in the limit of iterations share the model of a fit that
    stopped before their limits. An evaluator with ``evaluate_all`` judges up to ``TOGETHER`` models in the same jobs;
    ensembles of trees are too large to be kept for that and are judged one by one.
    """
    held = [(train.persist(), valid.persist()) for train, valid in sides]
    found = [[math.nan] * len(grid) for _ in held]
    together = hasattr(evaluator, "evaluate_all")

    def fit(job: tuple[int, list[int]]) -> list[tuple[int, list[int], Model | None]]:
        (pair, maps), out, stop, at = job, [], math.inf, []
        for n, i in enumerate(maps):  # the largest limit first
            if not n or stop > _limit(estimator, grid[i]):
                model, at = estimator.fit(held[pair][0], grid[i]), []
                stop = iterations(model)
                kept = model if together and not hasattr(model, "trees") else None
                out.append((pair, at, kept))
                value = math.nan if kept else evaluator.evaluate(model.transform(held[pair][1]))
            at.append(i)
            found[pair][i] = value
        return out

    def judge(part: list[tuple[int, list[int], Model]]) -> None:
        values = evaluator.evaluate_all(held[part[0][0]][1], [model for _, _, model in part])
        for (pair, maps, _), value in zip(part, values):
            for i in maps:
                found[pair][i] = value

    threaded = inheritable_thread_target(held[0][0].sparkSession)
    queue = [(pair, maps) for maps in by_limit(estimator, grid) for pair in range(len(held))]
    try:
        with ThreadPool(min(parallelism, len(queue))) as pool:
            fits = [f for out in pool.map(threaded(fit), queue, chunksize=1) for f in out if f[2]]
            by_pair = [[f for f in fits if f[0] == pair] for pair in range(len(held))]
            pool.map(threaded(judge), [fs[i : i + TOGETHER] for fs in by_pair for i in range(0, len(fs), TOGETHER)], chunksize=1)
    finally:
        for side in held:
            for df in side:
                df.unpersist()
    return found


def _limit(estimator: Estimator, point: dict) -> float:
    return point[estimator.getParam("maxIter")]


def by_limit(estimator: Estimator, grid: Sequence[dict]) -> list[list[int]]:
    """The maps in groups that agree in all but ``maxIter``, each with the largest limit first; a map without it is a group."""
    groups: dict[str | int, list[int]] = {}
    for i, point in enumerate(grid):
        rest = {p: v for p, v in point.items() if p.name != "maxIter"}
        groups.setdefault(label_of(rest) if len(rest) < len(point) else i, []).append(i)
    return [sorted(g, key=lambda i: -_limit(estimator, grid[i])) if len(g) > 1 else g for g in groups.values()]


def iterations(model: Model) -> float:
    """After how many iterations a fit stopped; infinity if the model does not say so.

    Up to there a fit does the same under any limit, so one with a limit of at least as many ends with the same model.
    """
    if not getattr(model, "hasSummary", False):
        return math.inf
    summary = model.summary() if callable(model.summary) else model.summary
    return getattr(summary, "totalIterations", math.inf)


def grid_search(
    df: DataFrame,
    estimator: Estimator,
    grid: Sequence[dict],
    evaluator: Evaluator,
    id: str,
    folds: int = 3,
    parallelism: int = 4,
    hash_fn: str = "murmur3",
    log_path: str | None = None,
    search: str = "grid",
) -> tuple[DataFrame, dict]:
    """Cross-validate every parameter map on folds by row id.

    Returns one row per map with the mean and deviation over the folds, and the
    best map. ``parallelism`` bounds the fits that run at the same time. The
    library's own cross-validator checks given folds row by row in Python, so
    the folds are plain filters here. With ``log_path`` the scores of the folds go to the run log there.
    """
    tagged = with_fold(df, id, folds, hash_fn)
    sides = [(tagged.filter(F.col("fold") != fold), tagged.filter(F.col("fold") == fold)) for fold in range(folds)]
    by_fold = _scores(sides, estimator, grid, evaluator, parallelism)
    per_map = list(zip(*by_fold))
    means = [fmean(s) for s in per_map]
    table = _result_table(df, grid, means, [pstdev(s) for s in per_map])
    if log_path:
        points = [{p.name: v for p, v in point.items()} for point in grid]
        log_trials(df.sparkSession, log_path, search, points, per_map)
    return table, grid[best_index(means, evaluator.isLargerBetter())]


def log_trials(spark: SparkSession, path: str, search: str, points: Sequence[Mapping], scores: Sequence[Sequence[float]], first: int = 0) -> None:
    """One run per trial of a search: its parameters, and its score on each fold as the steps of ``score``."""
    runlog.log_runs(spark, path, [
        {
            "run_id": f"{search}-{first + i:05d}",
            "run_name": f"{search} {first + i}",
            "params": {k: json.dumps(v) for k, v in point.items()},
            "metrics": {"score": [float(s) for s in fold_scores], "mean_score": fmean(fold_scores)},
            "tags": {"search": search, "trial": first + i},
        }
        for i, (point, fold_scores) in enumerate(zip(points, scores))
    ])


def logged_trials(spark: SparkSession, path: str, search: str, names: Sequence[str]) -> list[tuple[int, dict, float]]:
    """The trials of a search in the run log: number, parameters, mean score. A search's budget bounds their number."""
    _, kv = runlog.read_log(spark, path)
    wide = runlog.runs_wide(kv, ["mean_score"], names, ["search", "trial"]).filter(F.col("tag_search") == search)
    rows = wide.filter("metric_mean_score is not null").collect()
    found = [(int(r["tag_trial"]), {n: json.loads(r[f"param_{n}"]) for n in names}, r["metric_mean_score"]) for r in rows]
    return sorted(found, key=lambda t: t[0])


def random_search(
    df: DataFrame,
    estimator: Estimator,
    grid: Sequence[dict],
    evaluator: Evaluator,
    id: str,
    max_evals: int = 4,
    seed: int = 42,
    **options,
) -> tuple[DataFrame, dict]:
    """Cross-validate a seeded random choice of distinct parameter maps."""
    chosen = random.Random(seed).sample(list(grid), min(max_evals, len(grid)))
    return grid_search(df, estimator, chosen, evaluator, id, **options)


def refit(df: DataFrame, estimator: Estimator, point: dict) -> Model:
    """Train on all rows with one parameter map."""
    return estimator.copy(point).fit(df)


def validation_split(
    df: DataFrame,
    estimator: Estimator,
    grid: Sequence[dict],
    evaluator: Evaluator,
    id: str,
    train_ratio: float = 0.9,
    parallelism: int = 1,
    hash_fn: str = "murmur3",
) -> tuple[DataFrame, Model]:
    """Tune on one split by row id; returns the scores per map and the best model, fitted on all rows."""
    train, valid = hash_split(df, id, [train_ratio, 1 - train_ratio], hash_fn)
    (scores,) = _scores([(train, valid)], estimator, grid, evaluator, parallelism)
    best = grid[best_index(scores, evaluator.isLargerBetter())]
    return _result_table(df, grid, scores, [0.0] * len(scores)), refit(df, estimator, best)


def parzen_weights(history: Sequence[tuple[Mapping, float]], choices: Mapping[str, Sequence], share: float = 0.25, prior: float = 1.0) -> dict[str, list[float]]:
    """For each parameter and choice the log ratio of its density among the best trials to that among the others.

    Losses are in ``history``; the best ``share`` of them, rounded up, count as good. Densities are counts of the choices,
    each choice with ``prior`` more.
    """
    ranked = sorted(range(len(history)), key=lambda i: (math.inf if math.isnan(history[i][1]) else history[i][1], i))
    good = set(ranked[: math.ceil(share * len(ranked))])
    out = {}
    for name, values in choices.items():
        hits, rest = [0] * len(values), [0] * len(values)
        for i, (point, _) in enumerate(history):
            (hits if i in good else rest)[list(values).index(point[name])] += 1
        total, others = len(good) + prior * len(values), len(history) - len(good) + prior * len(values)
        out[name] = [math.log((h + prior) / total) - math.log((r + prior) / others) for h, r in zip(hits, rest)]
    return out


def suggest(history: Sequence[tuple[Mapping, float]], choices: Mapping[str, Sequence], seed: int = 42, startup: int = 10, **parzen) -> dict | None:
    """The untried point to try next: the first ``startup`` in random order, then that of the largest density ratio; None if all were tried.

    The order among equals is that of the random draw. The ratio is a sum over parameters, so points come out in its order
    without listing the grid.
    """
    tried = {json.dumps(dict(p), sort_keys=True) for p, _ in history}
    size = math.prod(len(v) for v in choices.values())
    if len(tried) >= size:
        return None
    names, draw = list(choices), random.Random(f"{seed}-{len(history)}")

    def fresh(point: dict) -> bool:
        return json.dumps(point, sort_keys=True) not in tried

    if len(history) < startup:
        while True:
            point = {n: draw.choice(list(choices[n])) for n in names}
            if fresh(point):
                return point
    weights = parzen_weights(history, choices, **parzen)
    order = {n: sorted(range(len(choices[n])), key=lambda i: (-weights[n][i], draw.random())) for n in names}
    steps = [[weights[n][i] for i in order[n]] for n in names]
    # best first over positions in the orders: a point comes after those that are better in one parameter
    queue, seen = [(0.0, (0,) * len(names))], {(0,) * len(names)}
    while queue:
        _, at = heapq.heappop(queue)
        point = {n: choices[n][order[n][i]] for n, i in zip(names, at)}
        if fresh(point):
            return point
        for k, i in enumerate(at):
            after = (*at[:k], i + 1, *at[k + 1 :])
            if i + 1 < len(steps[k]) and after not in seen:
                seen.add(after)
                heapq.heappush(queue, (sum(s[0] - s[j] for s, j in zip(steps, after)), after))
    return None


def adaptive_search(
    spark: SparkSession,
    choices: Mapping[str, Sequence],
    objective: Callable[[dict], Sequence[float]],
    log_path: str,
    search: str,
    max_evals: int = 4,
    larger_is_better: bool = True,
    **sampler,
) -> tuple[list[tuple[dict, float]], dict]:
    """A search whose next point follows from the results so far, by Parzen estimators over the choices.

    ``objective`` gives the scores of a point, one per fold. Trials are logged one by one, and a search that is called again
    under its name goes on after those in the log, with the same points as if it had not stopped. Returns
    the trials in order, with their mean scores, and the best point.
    """
    sign = -1.0 if larger_is_better else 1.0
    trials = [(point, score) for _, point, score in logged_trials(spark, log_path, search, list(choices))] if runlog.exists(spark, log_path) else []
    while len(trials) < max_evals:
        point = suggest([(p, sign * s) for p, s in trials], choices, **sampler)
        if point is None:
            break
        scores = list(objective(point))
        log_trials(spark, log_path, search, [point], [scores], first=len(trials))
        trials.append((point, fmean(scores)))
    return trials, trials[best_index([s for _, s in trials], larger_is_better)][0]


def fold_objective(df: DataFrame, estimator: Estimator, evaluator: Evaluator, id: str, folds: int = 2, parallelism: int = 4, hash_fn: str = "murmur3") -> Callable[[dict], list[float]]:
    """Scores on the folds of one point, given by the names of the estimator's parameters."""
    tagged = with_fold(df, id, folds, hash_fn)
    sides = [(tagged.filter(F.col("fold") != fold), tagged.filter(F.col("fold") == fold)) for fold in range(folds)]

    def scores(point: dict) -> list[float]:
        grid = [{estimator.getParam(name): value for name, value in point.items()}]
        return [s[0] for s in _scores(sides, estimator, grid, evaluator, parallelism)]

    return scores


def all_points(choices: Mapping[str, Sequence]) -> list[dict]:
    """The grid of the choices, the last parameter changing fastest."""
    return [dict(zip(choices, values)) for values in itertools.product(*choices.values())]
