"""The two batch workflows: train on a panel, forecast from a panel."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.numeric import col
from panelwright.models.learners import SEED, ModelSpec
from panelwright.models.training import Trained, train_models
from panelwright.operators.columns import (
    DEFAULT_FEATURE_KEYWORDS,
    FEATURE_BLACKLIST,
    add_year_column,
    modeling_frame,
    choose_target,
)
from panelwright.operators.extrapolate import TREND_METHODS, scenario
from panelwright.operators.ordered import (
    add_lag_features,
    choose_segments,
    contiguous_folds,
    fill_missing,
    temporal_split,
)
from panelwright.operators.reshape import drop_sparse_columns
from panelwright.operators.scoring import score_scenarios
from panelwright.operators.screening import screen_features
from panelwright.session import materialize
from panelwright.sources.reports import forecast_report


@dataclass
class TrainingRun:
    target: str
    features: list[str]
    dropped: DataFrame   # screened features and why
    prepared: DataFrame  # keys, features, target
    trained: Trained


def training_run(panel: DataFrame, target: str | None = None, features: list[str] | None = None,
                 keywords: list[str] = DEFAULT_FEATURE_KEYWORDS, max_features: int = 12,
                 blacklist: list[str] = FEATURE_BLACKLIST, sparse_threshold: float = 0.5,
                 leakage_threshold: float | None = 0.99, collinearity_threshold: float | None = 0.95,
                 lags: int = 0, train_end: int = 2010, specs: list[ModelSpec] | None = None,
                 tune_first: bool = False, cv: int = 5, seed: int = SEED,
                 entity_cols: list[str] = ["entity"], period: str = "period") -> TrainingRun:
    """Narrow, clean, fill, screen, lag, split, fit, evaluate.

    The driver waits only where columns depend on data: the period range, the
    sparse filter and the correlations - one aggregate each.  The filled panel
    is written once; screening and every fit read that table.
    """
    keys = [*entity_cols, period]
    spark = panel.sparkSession
    if target is None:
        names = [(c,) for c in sorted(panel.columns) if c not in keys]
        target = choose_target(spark.createDataFrame(names, "indicator string"))
        if target is None:
            raise ValueError("could not find a target indicator; pass target")
    # written first: null fractions, period range and filling read the table, not the pivot
    narrow = materialize(modeling_frame(panel, target, features, keywords, max_features, blacklist, keys), "narrow-panel")
    dense = drop_sparse_columns(narrow, sparse_threshold, keep=keys, target=target)
    segments = choose_segments(dense, period)
    filled = fill_missing(dense, entity_cols=entity_cols, period=period, segment_rows=segments)
    stored = materialize(filled, "filled-panel")
    screened = screen_features(stored, target, leakage_threshold=leakage_threshold,
                               collinearity_threshold=collinearity_threshold, keys=keys)
    data = screened.data
    kept = [c for c in data.columns if c not in keys and c != target]
    if lags:
        data = add_lag_features(data, kept, lags, entity_cols, period, segments)
    data = add_year_column(data, period)
    inputs = [c for c in data.columns if c not in keys and c != target]
    train, test = temporal_split(data, train_end, period)
    folds = None
    if tune_first:
        folds = "__fold_id"
        train = contiguous_folds(train, cv, entity_cols, period, folds, segments)
    trained = train_models(train, test, inputs, target, specs, tune_first, folds, keys, seed)
    return TrainingRun(target, inputs, screened.dropped, data, trained)


def forecast_run(panel: DataFrame, models: dict[str, PipelineModel], features: list[str],
                 target: str, last_period: int, target_period: int,
                 methods: list[str] = TREND_METHODS, entity_cols: list[str] = ["entity"],
                 period: str = "period", on_short: str = "raise") -> tuple[DataFrame, dict[str, str]]:
    """Extrapolate once for all methods, score every model, report beside the last known target.

    Features that the panel lacks are left out; a model that needs one of them
    is reported as failed and the others still score.
    """
    known = [f for f in features if f in panel.columns and f not in (period, "year")]
    rows = scenario(panel.select(*[col(c) for c in [*entity_cols, period, *known]]), known,
                    last_period, target_period, methods, entity_cols=entity_cols, period=period,
                    on_short=on_short)
    scored, failed = score_scenarios(rows, models, features, target_period, entity_cols, period)
    return forecast_report(scored.filter(F.col("prediction").isNotNull()), panel, target, last_period,
                           entity_cols, period), failed
