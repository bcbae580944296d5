"""Grid and random search over contiguous folds, scored by R2."""

from __future__ import annotations

import itertools
import random
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.numeric import col
from panelwright.models.learners import (
    INPUTS,
    SEED,
    ModelSpec,
    Scaling,
    assembler,
    bins_for,
    build_learner,
    fit_model,
)
from panelwright.models.trees import Version, read_trees, version_errors

# Parameter grids per model.
PARAM_GRIDS = {
    "LinearRegression": {},
    "Ridge": {"alpha": [0.001, 0.01, 0.1, 1.0, 10.0, 100.0]},
    "Lasso": {"alpha": [0.0001, 0.001, 0.01, 0.1, 1.0]},
    "DecisionTree": {
        "max_depth": [3, 5, 7, 10, 15, None],
        "min_samples_split": [2, 5, 10],
        "min_samples_leaf": [1, 2, 4],
    },
    "RandomForest": {
        "n_estimators": [50, 100, 200],
        "max_depth": [5, 10, 15, None],
        "min_samples_split": [2, 5, 10],
        "min_samples_leaf": [1, 2, 4],
    },
    "GradientBoosting": {
        "n_estimators": [50, 100, 150],
        "max_depth": [3, 5, 7],
        "learning_rate": [0.01, 0.05, 0.1],
        "subsample": [0.7, 0.9],
        "colsample_bytree": [0.7, 0.9],
    },
}

SCORES_SCHEMA = "model string, param_id int, params map<string,string>, fold int, score double"


@dataclass
class TuningResult:
    best_model: PipelineModel
    best_params: dict
    best_score: float | None
    scores: DataFrame   # one row per parameter set and fold
    results: DataFrame  # one row per parameter set


def grid_points(grid: dict[str, list]) -> list[dict]:
    """All parameter sets, names sorted, last name varying fastest."""
    names = sorted(grid)
    return [dict(zip(names, values)) for values in itertools.product(*[grid[n] for n in names])]


def random_points(grid: dict[str, list], n_iter: int, seed: int = SEED) -> list[dict]:
    """``n_iter`` distinct parameter sets drawn with a seed (all of them if fewer)."""
    points = grid_points(grid)
    return points if n_iter >= len(points) else random.Random(seed).sample(points, n_iter)


def summarize_scores(scores: DataFrame) -> DataFrame:
    """Mean, population std and min-rank of the fold scores per parameter set."""
    per = scores.groupBy("model", "param_id").agg(
        F.first("params").alias("params"),
        F.avg("score").alias("mean_test_score"),
        F.stddev_pop("score").alias("std_test_score"),
    )
    w = Window.partitionBy("model").orderBy(F.desc_nulls_last("mean_test_score"))
    return per.withColumn("rank_test_score", F.rank().over(w))


@dataclass
class FoldSums:
    """Sums over the rows of a fold: number, inputs and label, their products; whether the label is constant."""

    n: float
    sums: np.ndarray
    products: np.ndarray
    constant: bool


def fold_sums(ready: DataFrame, n_features: int, label_mean: float) -> dict[int, FoldSums]:
    """Sums per fold from one map-side aggregate; the label is taken less ``label_mean``."""
    xs = [F.col(f"__x{i}") for i in range(n_features)] + [F.col("__y") - label_mean]
    size = len(xs)
    upper = [(i, j) for i in range(size) for j in range(i, size)]
    per = ready.groupBy("__fold").agg(
        F.count(F.lit(1)), *[F.sum(x) for x in xs], *[F.sum(xs[i] * xs[j]) for i, j in upper],
        F.min("__y"), F.max("__y"),
    ).collect()
    out = {}
    for row in per:
        products = np.zeros((size, size))
        for (i, j), v in zip(upper, row[2 + size:]):
            products[i, j] = products[j, i] = v
        out[row[0]] = FoldSums(row[1], np.array(row[2:2 + size]), products, row[-2] == row[-1])
    return out


def ridge_path(gram: np.ndarray, target: np.ndarray, n: float, alphas: list[float]) -> list[np.ndarray]:
    """Ridge weights for every alpha from centred sums of products."""
    return [np.linalg.solve(gram + a * np.eye(len(gram)), target) for a in alphas]


def lasso_path(gram: np.ndarray, target: np.ndarray, n: float, alphas: list[float],
               tolerance: float = 1e-12, max_rounds: int = 100_000) -> list[np.ndarray]:
    """Lasso weights for every alpha by coordinate descent on centred sums of products.

    Minimises mean squares / 2 + alpha * |w|.  Alphas are taken from the largest
    down, each starting from the weights of the one before; a column without
    spread keeps weight 0.
    """
    g, c = gram / n, target / n
    spread, w, out = np.diag(g), np.zeros(len(c)), {}
    for a in sorted(set(alphas), reverse=True):
        for _ in range(max_rounds):
            change = 0.0
            for j in np.flatnonzero(spread > 0):
                pull = c[j] - g[j] @ w + spread[j] * w[j]
                new = np.sign(pull) * max(abs(pull) - a, 0.0) / spread[j]
                change = max(change, abs(new - w[j]) * np.sqrt(spread[j]))
                w[j] = new
            if change <= tolerance * max(1.0, np.sqrt(spread.max()) * np.abs(w).max()):
                break
        out[a] = w.copy()
    return [out[a] for a in alphas]


PATHS = {"Ridge": ridge_path, "Lasso": lasso_path}


def linear_fold_scores(kind: str, folds: dict[int, FoldSums], alphas: list[float]) -> list[tuple[int, int, float]]:
    """``(param, fold, R2)`` of every alpha and fold, from sums alone.

    Training sums are the total less the fold; the d x d systems are solved on the
    driver.  Searching more alphas passes over no row.
    """
    total = FoldSums(sum(f.n for f in folds.values()), sum(f.sums for f in folds.values()),
                     sum(f.products for f in folds.values()), False)
    out = []
    for fold, own in sorted(folds.items()):
        m = total.n - own.n
        means = (total.sums - own.sums) / m
        centred = total.products - own.products - m * np.outer(means, means)
        for p, w in enumerate(PATHS[kind](centred[:-1, :-1], centred[:-1, -1], m, alphas)):
            # Residual = c . (x, y) + shift with c = (-w, 1).
            c = np.append(-w, 1.0)
            shift = -c @ means
            sse = c @ own.products @ c + 2 * shift * (c @ own.sums) + own.n * shift * shift
            sst = own.products[-1, -1] - own.sums[-1] ** 2 / own.n
            # a constant fold scores 1 if predicted exactly (to rounding of the sums), else 0
            exact = sse <= 1e-12 * max(1.0, own.products[-1, -1])
            out.append((p, fold, float(exact) if own.constant else 1 - sse / sst))
    return out


# Parameters that need no fit of their own: a fitted model holds all smaller settings.
CUTS = {
    "DecisionTree": {"max_depth": None, "min_samples_split": 2},
    "RandomForest": {"max_depth": None, "min_samples_split": 2, "n_estimators": 100},
    "GradientBoosting": {"n_estimators": 100},
}


def version_of(spec: ModelSpec, point: dict) -> Version:
    p = {**CUTS[spec.kind], **spec.params, **point}
    depth = p["max_depth"] if "max_depth" in CUTS[spec.kind] else None
    return Version(int(p.get("n_estimators", 1)), depth, int(p.get("min_samples_split", 2)))


def tree_families(spec: ModelSpec, points: list[dict]) -> list[tuple[dict, list[int]]]:
    """Points that one fit serves: the parameters to fit, the largest of each that can be cut, and the points."""
    families: dict[tuple, list[int]] = {}
    for i, p in enumerate(points):
        key = tuple(sorted((k, str(v)) for k, v in p.items() if k not in CUTS[spec.kind]))
        families.setdefault(key, []).append(i)
    out = []
    for members in families.values():
        versions = [version_of(spec, points[i]) for i in members]
        fit = {k: v for k, v in {**spec.params, **points[members[0]]}.items() if k != "min_samples_split"}
        if "n_estimators" in CUTS[spec.kind]:
            fit["n_estimators"] = max(v.trees for v in versions)
        if "max_depth" in CUTS[spec.kind]:
            depths = [v.max_depth for v in versions]
            fit["max_depth"] = None if None in depths else max(depths)
        out.append((fit, members))
    return out


def tree_fold_scores(spec: ModelSpec, ready: DataFrame, points: list[dict], bins: int, seed: int,
                     parallelism: int) -> list[tuple[int, int, float]]:
    """``(param, fold, R2)`` of every point and fold.

    One fit serves all numbers of trees, and for trees and forests all depths and
    split limits (see ``trees``): the largest is fitted, the others are cut out of
    it.  Families of a fold are fitted from ``parallelism`` driver threads.
    """
    spark = ready.sparkSession
    label = F.col("__y")
    stats = ready.groupBy("__fold").agg(
        F.when(F.min(label) < F.max(label), F.var_pop(label) * F.count(label)).otherwise(F.lit(0.0)).alias("sst")).collect()
    families, out = tree_families(spec, points), []
    for fold, sst in sorted((r["__fold"], r["sst"]) for r in stats):
        inside, held = ready.filter(F.col("__fold") != fold), ready.filter(F.col("__fold") == fold)

        def errors(family: tuple[dict, list[int]]) -> list[tuple[int, float]]:
            fit, members = family
            model = build_learner(spec.kind, "__y", INPUTS, fit, seed, bins).fit(inside)
            trees = read_trees(model, spark)
            versions = [version_of(spec, points[i]) for i in members]
            return list(zip(members, version_errors(held, model, trees, versions, "__y"), strict=True))

        with ThreadPool(min(parallelism, len(families))) as pool:
            for p, sse in sorted(x for part in pool.map(errors, families) for x in part):
                out.append((p, fold, 1 - sse / sst if sst > 0 else float(sse == 0)))
    return out


def tune(spec: ModelSpec, train: DataFrame, features: list[str], target: str, scaling: Scaling,
         grid: dict[str, list] | None = None, fold: str = "fold", n_iter: int | None = None,
         seed: int = SEED, parallelism: int = 4) -> TuningResult:
    """Search, then refit the best parameters on all of ``train``.

    Inputs are scaled once with the statistics of the whole training set.  Ridge
    and lasso are searched from sums of products in one pass.  For trees one fit
    serves every setting that can be cut out of it; the fits of a fold run from
    ``parallelism`` driver threads.
    """
    spark = train.sparkSession
    grid = PARAM_GRIDS.get(spec.kind, {}) if grid is None else grid
    if not grid:
        return TuningResult(fit_model(spec, train, features, target, scaling, seed), {}, None,
                            spark.createDataFrame([], SCORES_SCHEMA),
                            summarize_scores(spark.createDataFrame([], SCORES_SCHEMA)))
    points = random_points(grid, n_iter, seed) if n_iter else grid_points(grid)
    kept = [f"__x{i}" for i in range(len(features))]
    ready = assembler(len(features)).transform(scaling.stage(spec.linear).transform(train)).select(
        col(fold).alias("__fold"), col(target).cast("double").alias("__y"), INPUTS, *kept)
    bins = bins_for(spec, scaling.distinct)
    if spec.kind in PATHS:
        found = linear_fold_scores(spec.kind, fold_sums(ready, len(features), scaling.label_mean), [p["alpha"] for p in points])
    elif spec.kind in CUTS:
        ready = ready.drop(*kept).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            found = tree_fold_scores(spec, ready, points, bins, seed, parallelism)
        finally:
            ready.unpersist()
    else:
        raise ValueError(f"{spec.kind} has no parameters to search")
    rows = [(spec.name, p, {n: str(v) for n, v in points[p].items()}, k, float(score)) for p, k, score in found]
    return _finish(spec, points, rows, train, features, target, scaling, seed)


def _finish(spec: ModelSpec, points: list[dict], rows: list[tuple], train: DataFrame,
            features: list[str], target: str, scaling: Scaling, seed: int) -> TuningResult:
    """Refit the parameter set with the best mean; the first one wins a tie."""
    scores = train.sparkSession.createDataFrame(rows, SCORES_SCHEMA)
    folds = len({r[3] for r in rows})
    means = [sum(r[4] for r in rows if r[1] == i) / folds for i in range(len(points))]
    best = max(range(len(points)), key=lambda i: (means[i], -i))
    chosen = ModelSpec(spec.name, spec.kind, {**spec.params, **points[best]})
    return TuningResult(
        fit_model(chosen, train, features, target, scaling, seed),
        points[best], means[best], scores, summarize_scores(scores),
    )


def tuning_summary(results: dict[str, TuningResult], spark) -> DataFrame:
    """One row per tuned model; models without a grid are left out."""
    return spark.createDataFrame(
        [(n, r.best_score, str(r.best_params)) for n, r in results.items() if r.best_params],
        "model string, best_score double, hyperparameters string",
    )
