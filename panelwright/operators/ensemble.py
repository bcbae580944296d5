"""Imputation, ensembles over models, intervals and scenario comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.numeric import col

# Fixed value: normal quantile of a 95 % interval.
Z95 = 1.96


def impute_mean(df: DataFrame, columns: list[str], by: list[str] = []) -> DataFrame:
    """Missing values become the column mean, overall or per ``by``.

    Means come from a map-side aggregate, not from a window that would gather
    each entity in one task; the join back is split by adaptive execution.
    """
    means = df.groupBy(*[col(b) for b in by]).agg(*[
        F.avg(col(c)).alias(f"__m{i}") for i, c in enumerate(columns)
    ])
    if not by:
        known = means.first()  # one number per column
        return df.select(*[
            F.coalesce(col(c), F.lit(known[columns.index(c)])).alias(c) if c in columns else col(c)
            for c in df.columns
        ])
    joined = df.join(means, by, "left")
    place = {c: i for i, c in enumerate(columns)}
    return joined.select(*[
        F.coalesce(col(c), F.col(f"__m{place[c]}")).alias(c) if c in place else col(c)
        for c in df.columns
    ])


def ensemble(predictions: DataFrame, by: list[str] = [], value: str = "prediction",
             z: float = Z95) -> DataFrame:
    """Mean and population std of the per-model mean predictions, with mean +- z std."""
    keys = [col(b) for b in by]
    per_model = predictions.groupBy(*keys, "model").agg(F.avg(col(value)).alias("__p"))
    out = per_model.groupBy(*keys).agg(
        F.count("__p").alias("n_models"), F.avg("__p").alias("mean"),
        F.stddev_pop("__p").alias("std"),
    )
    return out.select("*", (F.col("mean") - z * F.col("std")).alias("lower"),
                      (F.col("mean") + z * F.col("std")).alias("upper"))


def uncertainty_band(predictions: DataFrame, period: str = "period",
                     value: str = "prediction") -> DataFrame:
    """Ensemble mean, lower and upper bound per period."""
    return ensemble(predictions, [period], value).select(period, "mean", "lower", "upper")


def prediction_bounds(predictions: DataFrame, by: list[str] = [], value: str = "prediction",
                      z: float = Z95) -> DataFrame:
    """Mean +- z * population std / sqrt(n)."""
    mean = F.avg(col(value))
    margin = z * F.stddev_pop(col(value)) / F.sqrt(F.count(col(value)))
    return predictions.groupBy(*[col(b) for b in by]).agg(
        mean.alias("mean"), (mean - margin).alias("lower"), (mean + margin).alias("upper"))


def compare_scenarios(predictions: DataFrame, latest: DataFrame, methods: list[str],
                      by: list[str] = ["entity", "model"], entity_cols: list[str] = ["entity"],
                      value: str = "prediction", baseline: str = "linear") -> DataFrame:
    """One row per entity and model: value per method, change from the baseline
    method and from the last observation (``latest.current``), and the spread."""
    wide = predictions.groupBy(*[col(b) for b in by]).agg(
        *[F.avg(F.when(F.col("method") == m, col(value))).alias(m) for m in methods],
        (F.max(col(value)) - F.min(col(value))).alias("spread"),
    ).join(latest, entity_cols, "left")
    return wide.select(
        *[col(b) for b in by], "current", *methods,
        *[(F.col(m) - F.col(baseline)).alias(f"{m}_vs_{baseline}") for m in methods if m != baseline],
        *[(F.col(m) - F.col("current")).alias(f"{m}_vs_current") for m in methods],
        "spread",
    )


def latest_target(panel: DataFrame, target: str, entity_cols: list[str] = ["entity"],
                  period: str = "period") -> DataFrame:
    """Last non-null target per entity."""
    return panel.groupBy(*[col(k) for k in entity_cols]).agg(
        last_known(target, period).alias("current"))


def last_known(target: str, period: str = "period") -> Column:
    """Aggregate: the value of the latest row that has one."""
    return F.max_by(col(target).cast("double"), F.when(col(target).isNotNull(), col(period)))


def overall_spread(predictions: DataFrame, value: str = "prediction") -> DataFrame:
    """Most optimistic and most pessimistic model-scenario pair, and the distance."""
    label = F.concat_ws(" + ", "model", "method")
    return predictions.groupBy("model", "method").agg(F.avg(col(value)).alias("p")).agg(
        F.min("p").alias("optimistic"), F.min_by(label, F.struct("p", "model", "method")).alias("optimistic_case"),
        F.max("p").alias("pessimistic"),
        F.min_by(label, F.struct(-F.col("p"), F.col("model"), F.col("method"))).alias("pessimistic_case"),
        (F.max("p") - F.min("p")).alias("spread"),
    )
