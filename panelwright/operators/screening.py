"""Dropping features that leak the target or repeat each other."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.numeric import col
from panelwright.operators.stats import pair_correlations

# Correlations are compared after rounding, so the order of exact ties does not
# depend on how partial sums were merged.
DIGITS = 12

DROP_LOG = "feature string, kept_feature string, corr double, reason string"


@dataclass
class Screened:
    data: DataFrame
    dropped: DataFrame  # feature, kept_feature, corr, reason

    def names(self) -> list[str]:
        return [r["feature"] for r in self.dropped.orderBy("feature").collect()]


def _check(threshold: float) -> None:
    if not 0 <= threshold <= 1:
        raise ValueError("threshold must be between 0 and 1")


def _numbers(df: DataFrame, pairs: list[tuple[str, str]]) -> dict[tuple[str, str], float | None]:
    """Absolute correlations on the driver: one number per column pair, never rows."""
    if not pairs:
        return {}
    rows = pair_correlations(df, pairs).select("a", "b", F.round(F.abs("corr"), DIGITS).alias("c"))
    return {(r["a"], r["b"]): r["c"] for r in rows.collect()}


def leaking_features(corr: dict, target: str, features: list[str],
                     threshold: float) -> list[tuple[str, str, float, str]]:
    """An unknown (null) correlation never drops a feature."""
    return [
        (f, target, corr[(f, target)], "leakage") for f in features
        if corr[(f, target)] is not None and corr[(f, target)] >= threshold
    ]


def collinear_features(corr: dict, features: list[str], threshold: float,
                       mode: str = "greedy") -> list[tuple[str, str, float, str]]:
    """``greedy``: strongest pair first, drop the later column if neither is marked yet.

    ``any``: drop every column that has an earlier one at or above the threshold.
    """
    hits = [(a, b, corr[(a, b)]) for a, b in combinations(features, 2)
            if corr[(a, b)] is not None and corr[(a, b)] >= threshold]
    hits.sort(key=lambda p: -p[2])  # stable: ties keep column order
    marked: dict[str, tuple] = {}
    for a, b, c in hits:
        if b in marked or (mode == "greedy" and a in marked):
            continue
        marked[b] = (b, a, c, "collinearity")
    return list(marked.values())


def screen_features(df: DataFrame, target: str, features: list[str] | None = None,
                    leakage_threshold: float | None = 0.99,
                    collinearity_threshold: float | None = 0.95, mode: str = "greedy",
                    keys: list[str] = ["entity", "period"]) -> Screened:
    """Leakage filter, then collinearity filter, from one correlation pass."""
    if mode not in ("greedy", "any"):
        raise ValueError(f"unknown mode {mode!r}")
    for t in (leakage_threshold, collinearity_threshold):
        if t is not None:
            _check(t)
    names = features or [c for c in df.columns if c not in keys and c != target]
    pairs = [(f, target) for f in names] if leakage_threshold is not None else []
    if collinearity_threshold is not None:
        pairs += list(combinations(names, 2))
    corr = _numbers(df, pairs)
    log = []
    if leakage_threshold is not None:
        log += leaking_features(corr, target, names, leakage_threshold)
    if collinearity_threshold is not None:
        gone = {r[0] for r in log}
        log += collinear_features(corr, [n for n in names if n not in gone],
                                  collinearity_threshold, mode)
    gone = {r[0] for r in log}
    return Screened(
        df.select(*[col(c) for c in df.columns if c not in gone]),
        df.sparkSession.createDataFrame(log, DROP_LOG),
    )


def drop_leaking(df: DataFrame, target: str, threshold: float = 0.99, **options) -> Screened:
    return screen_features(df, target, leakage_threshold=threshold,
                           collinearity_threshold=None, **options)


def drop_collinear(df: DataFrame, target: str, threshold: float = 0.95, **options) -> Screened:
    return screen_features(df, target, leakage_threshold=None,
                           collinearity_threshold=threshold, **options)


def collinear_any(df: DataFrame, features: list[str], threshold: float = 0.95) -> DataFrame:
    """The ``any`` variant as one lazy query: columns with a strong earlier column."""
    _check(threshold)
    return (
        pair_correlations(df, list(combinations(features, 2)))
        .groupBy(F.col("b").alias("feature")).agg(F.max(F.abs("corr")).alias("max_corr"))
        .filter(F.round("max_corr", DIGITS) >= threshold)
    )


def leakage_alarm(metrics: DataFrame, model: str = "LinearRegression",
                  r2_above: float = 0.95) -> DataFrame:
    """Baseline rows whose test R2 is suspiciously good."""
    return metrics.filter((F.col("model") == model) & (F.col("R2") > r2_above))
