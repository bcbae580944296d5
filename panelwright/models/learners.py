"""Regressors on ``pyspark.ml``: fixed scaling, alpha-style penalties, tree defaults."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.numeric import col, q
from panelwright.models.trees import LEAF, cut_stage, read_trees

SEED = 42
MAX_DEPTH = 30  # Spark's limit; stands for "no limit"

LINEAR_MODELS = ["LinearRegression", "Ridge", "Lasso"]
TREE_MODELS = ["DecisionTree", "RandomForest", "GradientBoosting"]


class AlphaRegression(Estimator):
    """Linear regression whose penalty is given as alpha on the raw label.

    ``pyspark.ml`` penalises on a standardised label, so the same alpha needs a
    different ``regParam`` for every training set; it is worked out at fit time.
    ``l1=False``: sum of squares + alpha * |w|^2.
    ``l1=True``: mean of squares / 2 + alpha * |w|_1.
    """

    alpha = Param(Params._dummy(), "alpha", "penalty on the raw label scale", TypeConverters.toFloat)
    l1 = Param(Params._dummy(), "l1", "lasso instead of ridge", TypeConverters.toBoolean)
    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, alpha: float = 1.0, l1: bool = False, labelCol: str = "label",
                 featuresCol: str = "features"):
        super().__init__()
        self._setDefault(alpha=1.0, l1=False, labelCol="label", featuresCol="features")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame):
        label = self.getOrDefault(self.labelCol)
        alpha = self.getOrDefault(self.alpha)
        base = LinearRegression(labelCol=label, featuresCol=self.getOrDefault(self.featuresCol),
                                standardization=False)
        if self.getOrDefault(self.l1):
            return base.copy({base.regParam: alpha, base.elasticNetParam: 1.0,
                              base.maxIter: 10000, base.tol: 1e-12}).fit(dataset)
        n, sd = dataset.agg(F.count(F.lit(1)), F.stddev_pop(col(label))).first()
        penalty = alpha / n * sd if n and sd else 0.0  # constant label: nothing to shrink
        return base.copy({base.regParam: penalty, base.elasticNetParam: 0.0,
                          base.solver: "normal"}).fit(dataset)


@dataclass
class Scaling:
    """Training means and population deviations; a constant column has scale 1."""

    features: list[str]
    means: list[float]
    scales: list[float]
    n_rows: int
    distinct: int  # largest estimated distinct count of a feature
    label_mean: float = 0.0

    def stage(self, linear: bool) -> SQLTransformer:
        """A saved, JVM-side stage adding the model inputs ``__x<i>``.

        Linear models get standardised values with the exact training
        statistics, trees the raw ones.  The plain names also keep dots and
        spaces of indicator names away from the vector assembler.
        """
        def term(f: str, m: float, s: float) -> str:
            raw = f"CAST({q(f)} AS DOUBLE)"
            return f"({raw} - CAST('{m!r}' AS DOUBLE)) / CAST('{s!r}' AS DOUBLE)" if linear else raw

        terms = [f"{term(f, m, s)} AS __x{i}"
                 for i, (f, m, s) in enumerate(zip(self.features, self.means, self.scales))]
        return SQLTransformer(statement=f"SELECT *, {', '.join(terms)} FROM __THIS__")


def fit_scaling(train: DataFrame, features: list[str], target: str | None = None,
                count_distinct: bool = True) -> Scaling:
    """One aggregate over the training rows; missing values are an error.

    Distinct values matter to trees only (one split candidate each).
    """
    label = col(target).cast("double") if target else F.lit(0.0)
    stats = train.agg(*[
        e for f in features for e in (
            F.avg(col(f)), F.stddev_pop(col(f)), F.count(col(f)),
            F.approx_count_distinct(col(f), 0.02) if count_distinct else F.lit(0),
        )
    ], F.count(F.lit(1)), F.count(label), F.avg(label)).first()
    n = stats[-3]
    if n == 0:
        raise ValueError("no training rows")
    missing = [f for i, f in enumerate(features) if stats[4 * i + 2] < n]
    if target and stats[-2] < n:
        missing.append(target)
    if missing:
        raise ValueError(f"missing values in training columns: {missing}")
    return Scaling(
        list(features),
        [float(stats[4 * i]) for i in range(len(features))],
        [float(stats[4 * i + 1]) or 1.0 for i in range(len(features))],
        n,
        max(int(stats[4 * i + 3] * 1.1) + 1 for i in range(len(features))),
        float(stats[-1]),
    )


def scaled(df: DataFrame, scaling: Scaling) -> DataFrame:
    """The feature columns replaced by their standardised values."""
    place = {f: i for i, f in enumerate(scaling.features)}
    return df.select(*[
        ((col(c) - F.lit(scaling.means[place[c]])) / F.lit(scaling.scales[place[c]])).alias(c)
        if c in place else col(c) for c in df.columns
    ])


@dataclass
class ModelSpec:
    """What to fit: a model name, its kind and parameters of the learner.

    ``max_bins`` bounds the split candidates of a feature in trees.  Up to that
    many distinct values each one is a candidate; beyond it Spark takes quantiles
    of a sample, which is reported as a warning.
    """

    name: str
    kind: str
    params: dict = field(default_factory=dict)
    max_bins: int = 1024

    @property
    def linear(self) -> bool:
        return self.kind in LINEAR_MODELS


def default_specs(ridge: bool = False, lasso: bool = False, boosting: bool = False,
                  linear: bool = True, tree: bool = True, forest: bool = True) -> list[ModelSpec]:
    """Three base models, optional ridge, lasso and boosting; every flag is honoured."""
    wanted = [("LinearRegression", linear), ("DecisionTree", tree), ("RandomForest", forest),
              ("Ridge", ridge), ("Lasso", lasso), ("GradientBoosting", boosting)]
    return [ModelSpec(n, n) for n, on in wanted if on]


def bins_for(spec: ModelSpec, distinct: int) -> int:
    """Split candidates per feature: every distinct value up to the spec's ``max_bins``."""
    if not spec.linear and distinct > spec.max_bins:
        warnings.warn(f"{spec.name}: about {distinct} distinct values, max_bins is {spec.max_bins}; "
                      "splits are chosen among quantiles", stacklevel=3)
    return max(32, min(spec.max_bins, distinct))


def build_learner(kind: str, label: str, features_col: str, params: dict | None = None,
                  seed: int = SEED, max_bins: int = 256):
    """An unfitted learner.  ``None`` depth means the maximum Spark allows."""
    p = dict(params or {})
    common = {"labelCol": label, "featuresCol": features_col}
    if kind == "LinearRegression":
        return LinearRegression(solver="normal", regParam=0.0, standardization=False, **common)
    if kind in ("Ridge", "Lasso"):
        return AlphaRegression(alpha=float(p.get("alpha", 1.0)), l1=kind == "Lasso", **common)
    depth = MAX_DEPTH if p.get("max_depth", None) is None else min(int(p["max_depth"]), MAX_DEPTH)
    leaf = int(p.get("min_samples_leaf", 1))
    trees = {**common, "maxBins": max_bins, "minInstancesPerNode": leaf, "seed": seed, "leafCol": LEAF}
    if kind == "DecisionTree":
        return DecisionTreeRegressor(maxDepth=depth, **trees)
    if kind == "RandomForest":
        return RandomForestRegressor(
            numTrees=int(p.get("n_estimators", 100)), maxDepth=depth,
            featureSubsetStrategy="all", bootstrap=bool(p.get("bootstrap", True)), **trees,
        )
    if kind == "GradientBoosting":
        return GBTRegressor(
            maxIter=int(p.get("n_estimators", 100)),
            maxDepth=6 if p.get("max_depth") is None else depth,
            # Spark's squared-error residual is twice the error; the first tree has full weight.
            stepSize=float(p.get("learning_rate", 0.3)) / 2,
            subsamplingRate=float(p.get("subsample", 1.0)),
            featureSubsetStrategy=str(p.get("colsample_bytree", "all")), **trees,
        )
    raise ValueError(f"unknown model kind {kind!r}")


INPUTS = "__inputs"
LABEL = "__label"


def assembler(n_features: int) -> VectorAssembler:
    # "keep" marks a missing input as NaN; the scoring step nulls such rows.
    return VectorAssembler(inputCols=[f"__x{i}" for i in range(n_features)], outputCol=INPUTS,
                           handleInvalid="keep")


def fit_model(spec: ModelSpec, train: DataFrame, features: list[str], target: str,
              scaling: Scaling, seed: int = SEED) -> PipelineModel:
    """Input scaling, assembler and learner as one saved unit.

    ``min_samples_split`` of a tree or forest is kept by cutting what hangs below
    smaller nodes; in a forest the rows of a node are those its tree has drawn.
    """
    learner = build_learner(spec.kind, LABEL, INPUTS, spec.params, seed, bins_for(spec, scaling.distinct))
    stages = [scaling.stage(spec.linear), assembler(len(features)), learner]
    fitted = Pipeline(stages=stages).fit(train.withColumn(LABEL, col(target).cast("double")))
    least = int(spec.params.get("min_samples_split", 2))
    if least <= 2 or spec.kind not in ("DecisionTree", "RandomForest"):
        return fitted
    model = fitted.stages[-1]
    cut = cut_stage(model, read_trees(model, train.sparkSession), len(features), None, least)
    return PipelineModel([*fitted.stages, cut])
