"""Train, evaluate, save and load a set of models."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from panelwright.functions.numeric import col
from panelwright.models.learners import (
    SEED,
    ModelSpec,
    Scaling,
    default_specs,
    fit_model,
    fit_scaling,
)
from panelwright.models.scores import (
    actual_vs_predicted,
    regression_metrics,
    score_models,
    tree_importance,
)
from panelwright.models.tuning import PARAM_GRIDS, TuningResult, tune
from panelwright.sources.files import path_exists


#: A training task gets no less than the first number of bytes of rows, and no more than the second.
TASK_BYTES, MOST_TASK_BYTES = 1 << 20, 32 << 20


@dataclass
class Trained:
    models: dict[str, PipelineModel]
    scaling: Scaling
    features: list[str]
    target: str
    predictions: DataFrame  # keys, actual, prediction, residual, model
    metrics: DataFrame      # model, MAE, RMSE, R2
    importance: DataFrame   # tree models, ranked
    tuning: dict[str, TuningResult]


def training_tasks(n_rows: int, n_columns: int, cores: int) -> int:
    """No more tasks than there are megabytes; from as many as cores on, a multiple of these, so no core waits for a last few."""
    size = n_rows * n_columns * 8
    return min(-(-size // TASK_BYTES), cores * -(-size // (cores * MOST_TASK_BYTES)))


def evenly_spread(rows: DataFrame, n_rows: int) -> DataFrame:
    """The rows in tasks of one size, their place and order a matter of their values alone.

    Trees pass over them hundreds of times, each time as long as the largest task or
    the last wave of tasks; a forest's draws hang on place and order.
    """
    columns = [col(c) for c in rows.columns]
    tasks = training_tasks(n_rows, len(columns), rows.sparkSession.sparkContext.defaultParallelism)
    return rows.repartition(tasks, *columns).sortWithinPartitions(*columns)


def train_models(train: DataFrame, test: DataFrame, features: list[str], target: str,
                 specs: list[ModelSpec] | None = None, tune_first: bool = False, folds: str | None = None,
                 keys: list[str] = ["entity", "period"], seed: int = SEED,
                 grids: dict[str, dict] = PARAM_GRIDS, parallelism: int = 4) -> Trained:
    """Fit every spec on ``train`` and score all of them on ``test`` in one pass.

    Linear models see standardised inputs, trees raw ones.  ``tune_first`` grid
    searches over the fold column ``folds`` of ``train`` and refits the best.
    """
    if target in features:
        raise ValueError("the target cannot be a feature")
    needed = [*keys, *features, target, *([folds] if folds else [])]
    narrow = train.select(*[col(c) for c in needed]).persist(StorageLevel.MEMORY_AND_DISK)
    held = [narrow]
    try:
        wanted = specs or default_specs()
        linear = all(s.linear for s in wanted)
        scaling = fit_scaling(narrow, features, target, count_distinct=not linear)
        if linear:
            dense = narrow.coalesce(-(-scaling.n_rows * len(needed) * 8 // TASK_BYTES))
        else:
            dense = evenly_spread(narrow, scaling.n_rows).persist(StorageLevel.MEMORY_AND_DISK)
            held.append(dense)
        models, tuning = {}, {}
        for spec in wanted:
            if tune_first:
                tuning[spec.name] = tune(spec, dense, features, target, scaling,
                                         grid=grids.get(spec.kind, {}), fold=folds, seed=seed,
                                         parallelism=parallelism)
                models[spec.name] = tuning[spec.name].best_model
            else:
                models[spec.name] = fit_model(spec, dense, features, target, scaling, seed)
    finally:
        for rows in held:
            rows.unpersist()
    scored = score_models(test.select(*[col(c) for c in [*keys, *features, target]]), models,
                          features, keep=[*keys, target])
    return Trained(
        models, scaling, features, target,
        actual_vs_predicted(scored, target, [*keys, "model"]),
        regression_metrics(scored, target),
        tree_importance(train.sparkSession, models, features),
        tuning,
    )


def save_models(models: dict[str, PipelineModel], folder: str) -> None:
    for name, model in models.items():
        model.write().overwrite().save(f"{folder}/{name}")


def load_models(spark: SparkSession, folder: str, names: list[str],
                unreadable: dict[str, str] | None = None) -> dict[str, PipelineModel]:
    """Every model that can be read; an error only when none can.

    Models that are there but cannot be read are logged, and put into
    ``unreadable`` with the reason.
    """
    found = {}
    for name in names:
        if not path_exists(spark, f"{folder}/{name}"):
            continue
        try:
            found[name] = PipelineModel.load(f"{folder}/{name}")
        except Exception as broken:  # noqa: BLE001  whatever a damaged folder makes Spark raise
            reason = str(broken).splitlines()[0]
            logging.getLogger(__name__).warning("model %s cannot be read: %s", name, reason)
            if unreadable is not None:
                unreadable[name] = reason
    if not found:
        raise FileNotFoundError(f"no models found in {folder}")
    return found
