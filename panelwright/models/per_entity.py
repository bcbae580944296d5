"""Linear models of every entity at once: sums per entity, solved many at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.numeric import col, q

#: Eigenvalues this small against the largest count as none.
RANK = 1e-12


def entity_moments(df: DataFrame, features: list[str], target: str, by: list[str]) -> DataFrame:
    """Rows, means and population (co)variances of complete rows per entity, combined map-side."""
    names = [*features, target]
    complete = F.lit(True)
    for c in names:
        complete = complete & col(c).isNotNull()
    values = {c: F.when(complete, col(c).cast("double")) for c in names}
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names)) if i < len(features)]
    return df.groupBy(*[col(k) for k in by]).agg(
        F.count_if(complete).alias("n"),
        F.array(*[F.avg(values[c]) for c in names]).alias("means"),
        F.array(*[F.covar_pop(values[names[i]], values[names[j]]) for i, j in pairs]).alias("products"))


def fit_per_entity(df: DataFrame, features: list[str], target: str, alpha: float = 0.0, by: list[str] = ["entity"],
                   least_rows: int | None = None) -> DataFrame:
    """``(by.., n_rows, intercept, weights array<double>, status)`` of a model per entity.

    Least squares, or ridge with ``alpha``, on features standardised by the entity's
    own population spread; weights are given for the plain features.  Rows with a
    missing value don't count.  Entities with fewer than ``least_rows`` such rows
    (default: one more than there are features) have status ``too_few_rows`` and no
    weights.  A feature without spread gets weight 0; of features that repeat each
    other, least squares takes the solution of least norm.

    An entity sends one row of d x d sums per task; systems are solved in batches
    where the entities are, so neither rows nor models pass the driver.
    """
    if not features or target in features:
        raise ValueError("features must be named, the target cannot be one")
    if alpha < 0:
        raise ValueError("alpha must not be negative")
    d, least = len(features), len(features) + 1 if least_rows is None else least_rows
    moments = entity_moments(df, features, target, by)
    kept = ", ".join(f"{q(k)} {moments.schema[k].dataType.simpleString()}" for k in by)
    schema = f"{kept}, n_rows long, intercept double, weights array<double>, status string"
    rows = moments.select(*[col(k).alias(f"k{i}") for i, k in enumerate(by)], "n", "means", "products")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").to_numpy()
            good = np.flatnonzero(n >= max(1, least))
            weights, intercept = solve(*[np.array(batch.column(c).take(pa.array(good)).to_pylist(), dtype=float).reshape(len(good), size)
                                         for c, size in (("means", d + 1), ("products", d * (d + 3) // 2))], n[good], alpha)
            all_weights, all_intercepts = [None] * len(n), [None] * len(n)
            for k, w, b in zip(good.tolist(), weights.tolist(), intercept.tolist(), strict=True):
                all_weights[k], all_intercepts[k] = w, b
            status = np.where(n >= max(1, least), "ok", "too_few_rows").tolist()
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f"k{i}") for i in range(len(by))], batch.column("n"), pa.array(all_intercepts, pa.float64()),
                 pa.array(all_weights, pa.list_(pa.float64())), pa.array(status)], names=[*by, "n_rows", "intercept", "weights", "status"])

    return rows.mapInArrow(run, schema)


def solve(means: np.ndarray, products: np.ndarray, n: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """(weights, intercepts) of systems given row by row."""
    d = means.shape[1] - 1
    gram, target = np.zeros((len(n), d, d)), np.zeros((len(n), d))
    at = 0
    for i in range(d):
        for j in range(i, d):
            gram[:, i, j] = gram[:, j, i] = products[:, at]
            at += 1
        target[:, i] = products[:, at]
        at += 1
    scale = np.sqrt(np.einsum("kii->ki", gram))
    flat = scale <= 1e-14 * np.abs(means[:, :d])
    scale[flat] = 1.0
    gram = gram / scale[:, :, None] / scale[:, None, :]
    target = np.where(flat, 0.0, target / scale)
    gram[flat[:, :, None] | flat[:, None, :]] = 0.0
    gram = gram + (alpha / n)[:, None, None] * np.eye(d)
    weights = np.einsum("kij,kj->ki", np.linalg.pinv(gram, rcond=RANK, hermitian=True), target) / scale if len(n) else target
    weights[flat] = 0.0
    return weights, means[:, d] - (weights * means[:, :d]).sum(1)


def score_per_entity(df: DataFrame, fitted: DataFrame, features: list[str], by: list[str] = ["entity"]) -> DataFrame:
    """``df`` with ``prediction`` by each entity's own model; NULL where it has none or a feature is missing."""
    models = fitted.select(*[col(k) for k in by], F.col("intercept").alias("__b"), F.col("weights").alias("__w"))
    value = F.col("__b")
    for i, f in enumerate(features):
        value = value + F.get(F.col("__w"), F.lit(i)) * col(f).cast("double")
    return df.join(models, by, "left").select(*[col(c) for c in df.columns], value.alias("prediction"))
