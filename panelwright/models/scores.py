"""Metrics, predictions of many models in one pass, importance, partial dependence."""

from __future__ import annotations

import json

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.numeric import col, nan_to_null, q
from panelwright.models.trees import CutTrees, leaf_weights, ranges_of, read_trees, tree_weights

METRICS_SCHEMA = "model string, MAE double, RMSE double, R2 double"
IMPORTANCE_SCHEMA = "feature string, importance double, rank int, model string"

# Fixed value: model used when no metrics are known.
DEFAULT_MODEL = "Lasso"


def r2_from_sums(sse: Column, sst: Column) -> Column:
    """Constant truth scores 1 if predicted exactly, else 0."""
    return F.when(sst > 0, 1 - sse / sst).when(sse == 0, F.lit(1.0)).when(
        sse.isNotNull(), F.lit(0.0))


def metric_columns(truth: Column, guess: Column) -> dict[str, Column]:
    error = truth - guess
    seen = F.when(error.isNotNull(), truth)
    sse = F.sum(error * error)
    # Population variance times n; min = max is the exact test for constant truth.
    sst = F.when(F.min(seen) < F.max(seen), F.var_pop(seen) * F.count(seen)).otherwise(F.lit(0.0))
    return {
        "MAE": F.avg(F.abs(error)),
        "RMSE": F.sqrt(F.avg(error * error)),
        "R2": r2_from_sums(sse, sst),
    }


def regression_metrics(df: DataFrame, truth: str, prediction: str = "prediction",
                       by: list[str] = ["model"]) -> DataFrame:
    """MAE, RMSE and R2 per group, one map-side aggregate."""
    exprs = metric_columns(col(truth), col(prediction))
    return df.groupBy(*[col(c) for c in by]).agg(*[e.alias(n) for n, e in exprs.items()])


def score_wide(df: DataFrame, models: dict[str, PipelineModel],
               features: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """Add one prediction column per model; rows with a missing feature get NULL.

    All models run in the same pass over ``df`` - no re-scan per model.
    """
    out, names = df, {}
    complete = F.lit(True)
    for f in features:
        complete = complete & col(f).isNotNull()
    for i, (name, model) in enumerate(models.items()):
        before = out.columns
        target = f"__pred{i}"
        out = model.transform(out)
        out = out.select(*[col(c) for c in before],
                         F.when(complete, nan_to_null(F.col("prediction"))).alias(target))
        names[name] = target
    return out, names


def score_models(df: DataFrame, models: dict[str, PipelineModel], features: list[str],
                 keep: list[str] | None = None) -> DataFrame:
    """Long predictions ``(keep.., model, prediction)``."""
    wide, names = score_wide(df, models, features)
    kept = keep if keep is not None else df.columns
    rows = F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(c).alias("prediction")) for m, c in names.items()
    ])
    return (wide.select(*[col(c) for c in kept], F.explode(rows).alias("__p"))
            .select(*[col(c) for c in kept], "__p.model", "__p.prediction"))


def actual_vs_predicted(predictions: DataFrame, target: str,
                        keys: list[str] = ["entity", "period", "model"]) -> DataFrame:
    return predictions.select(
        *[col(k) for k in keys], col(target).alias("actual"), "prediction",
        (col(target) - F.col("prediction")).alias("residual"),
    )


def best_model(metrics: DataFrame, default: str = DEFAULT_MODEL) -> str:
    """Name with the highest R2; ties go to the first name; ``default`` without metrics."""
    row = best_model_row(metrics).first()
    return row["model"] if row and row["model"] is not None else default


def best_model_row(metrics: DataFrame) -> DataFrame:
    return metrics.filter("R2 is not null").agg(
        F.min_by("model", F.struct(-F.col("R2"), F.col("model"))).alias("model"),
        F.max("R2").alias("R2"),
    )


def model_listing(metrics: DataFrame, available: list[str], features: list[str],
                  digits: int = 4) -> DataFrame:
    """Loaded models with rounded metrics (null where none are known), the default flagged, and the features."""
    default = best_model(metrics)
    names = metrics.sparkSession.createDataFrame([(n,) for n in available], "model string")
    return names.join(metrics, "model", "left").select(
        "model", *[F.round(m, digits).alias(m.lower()) for m in ("MAE", "RMSE", "R2")],
        (F.col("model") == default).alias("is_default"),
        F.array(*[F.lit(f) for f in features]).alias("feature_columns"),
    )


# --- importance -----------------------------------------------------------------


def raw_importance(model: PipelineModel, features: list[str]) -> list[tuple[str, float, bool]]:
    """(feature, importance, is_tree); linear models give the size of the coefficient."""
    learner = model.stages[-1]
    if hasattr(learner, "featureImportances"):
        return [(f, float(v), True) for f, v in zip(features, learner.featureImportances.toArray())]
    return [(f, abs(float(v)), False) for f, v in zip(features, learner.coefficients.toArray())]


def rank_importance(rows: DataFrame) -> DataFrame:
    """Add the 1-based ``rank`` per model, most important first."""
    w = Window.partitionBy("model").orderBy(F.desc("importance"), "feature")
    return rows.select("feature", "importance", F.row_number().over(w).alias("rank"), "model")


def tree_importance(spark, models: dict[str, PipelineModel], features: list[str]) -> DataFrame:
    """Ranked importance of the tree models; linear models have none."""
    rows = [(f, v, n) for n, m in models.items() for f, v, tree in raw_importance(m, features) if tree]
    return rank_importance(spark.createDataFrame(rows, "feature string, importance double, model string"))


def normalized_importance(spark, models: dict[str, PipelineModel],
                          features: list[str]) -> DataFrame:
    """Tree importance or coefficient size, divided by the largest of the model."""
    rows = [(f, v, n) for n, m in models.items() for f, v, _ in raw_importance(m, features)]
    return normalize_importance(
        spark.createDataFrame(rows, "feature string, importance double, model string"))


def normalize_importance(rows: DataFrame) -> DataFrame:
    top = F.max(F.abs("importance")).over(Window.partitionBy("model"))
    return rows.select(
        "feature",
        F.when(top > 0, F.col("importance") / top).otherwise(F.col("importance")).alias("importance"),
        "model",
    )


def top_features(importance: DataFrame, n: int = 10) -> DataFrame:
    """Rows of the ``n`` features with the largest mean importance across models."""
    top = (importance.groupBy("feature").agg(F.avg("importance").alias("__m"))
           .orderBy(F.desc("__m"), "feature").limit(n))
    return importance.join(top, "feature", "left_semi")


# --- partial dependence ---------------------------------------------------------


def partial_dependence(df: DataFrame, model: PipelineModel, features: list[str], feature: str,
                       n_points: int = 30) -> DataFrame:
    """Mean prediction with ``feature`` set to each of ``n_points`` values, min to max.

    No row is repeated per grid point.  For a linear model the mean prediction is
    its value at the mean of the other inputs.  For trees one pass counts the rows
    that each leaf gets if splits of ``feature`` are passed on both sides; a grid
    point adds up the leaves whose range holds it.  Rows with a missing feature
    don't count, the range is that of all rows.
    """
    low, high = df.agg(F.min(col(feature)), F.max(col(feature))).first()
    if low is None:
        raise ValueError(f"no values in {feature!r}")
    spark, place = df.sparkSession, features.index(feature)
    step = (high - low) / max(n_points - 1, 1)
    grid = [float(high) if k and k == n_points - 1 else float(low) + k * step for k in range(n_points)]
    whole = df.select(*[col(f) for f in features])
    for f in features:
        whole = whole.where(col(f).isNotNull())
    inputs = [f"__x{i}" for i in range(len(features))]
    scaler, learner = model.stages[0], next(s for s in model.stages if hasattr(s, "coefficients") or hasattr(s, "featureImportances"))
    if hasattr(learner, "coefficients"):
        means = scaler.transform(whole).agg(*[F.avg(x) for x in inputs]).first()
        points = spark.createDataFrame([(k, *[v] * len(features)) for k, v in enumerate(grid)],
                                       "point int, " + ", ".join(f"{q(f)} double" for f in features))
        moved = {r["point"]: r[inputs[place]] for r in scaler.transform(points).select("point", inputs[place]).collect()}
        weights = learner.coefficients.toArray()
        rest = learner.intercept + sum(w * m for i, (w, m) in enumerate(zip(weights, means, strict=True)) if i != place) \
            if means[0] is not None else None
        value = [None if rest is None else float(rest + weights[place] * moved[k]) for k in range(n_points)]
    else:
        trees = read_trees(learner, spark)
        weights = tree_weights(learner, len(trees))
        least = next((s for s in model.stages if isinstance(s, CutTrees)), None)
        values = json.loads(least.getOrDefault(least.values)) if least else [t.prediction[t.leaves].tolist() for t in trees]
        rows = leaf_weights(scaler.transform(whole), inputs, trees, place)
        total, value, at = 0, np.zeros(n_points), 0
        for t, w, own in zip(trees, weights, values, strict=True):
            n = rows[at:at + len(own)]
            bounds = ranges_of(t, place)
            hit = (bounds[0][None, :] < np.array(grid)[:, None]) & (np.array(grid)[:, None] <= bounds[1][None, :])
            value += w * (hit * (n * np.array(own))[None, :]).sum(1)
            total = (hit * n[None, :]).sum(1)[0] if not total else total
            at += len(own)
        value = [float(v / total) if total else None for v in value]
    return spark.createDataFrame([(k, g, v, feature) for k, (g, v) in enumerate(zip(grid, value, strict=True))],
                                 "point int, feature_value double, prediction double, feature string")
