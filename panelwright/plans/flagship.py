"""The flagship query: long events to scored test days."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelwright.models.learners import ModelSpec
from panelwright.models.training import train_models
from panelwright.operators.ordered import add_lag_features, temporal_split
from panelwright.plans.canonical import events_segments, events_stored


def flagship(spark: SparkSession, sf_dir: str, train_end: int = 20) -> DataFrame:
    """Metrics of least squares on the last day's values of every user."""
    panel = events_stored(spark, sf_dir).select("entity", "period", "click", "error", "view")
    lagged = add_lag_features(panel, ["click", "error", "view"], lags=1,
                              segment_rows=events_segments(spark, sf_dir))
    train, test = temporal_split(lagged, train_end)
    fitted = train_models(train, test, ["click_lag1", "error_lag1", "view_lag1"], "view",
                          [ModelSpec("LinearRegression", "LinearRegression")])
    return fitted.metrics
