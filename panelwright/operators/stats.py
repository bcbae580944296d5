"""Descriptive statistics, correlations, comparisons of models and scenarios."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.crossprod import blocked_correlations
from panelwright.functions.numeric import col, melt, pair_corr
from panelwright.functions.quantile import exact_median
from panelwright.sources.longtable import union_all

# Expressions that one aggregate takes; more pairs are computed as blocks of products.
PAIRS_PER_AGGREGATE = 250

# Metrics where the smallest value is best.
LOWER_IS_BETTER = ["MAE", "RMSE", "MAPE"]
HIGHER_IS_BETTER = ["R2"]


def _keys(names: list[str]) -> list[Column]:
    return [col(n) for n in names]


def unpivot_row(df: DataFrame, keys: list[str], cells: list[dict[str, Column]]) -> DataFrame:
    """Explode one wide row into one row per entry of ``cells``."""
    rows = F.array(*[F.struct(*[c.alias(k) for k, c in cell.items()]) for cell in cells])
    return (df.select(*_keys(keys), F.explode(rows).alias("__r"))
            .select(*_keys(keys), *[F.col(f"__r.{k}").alias(k) for k in cells[0]]))


def column_statistics(df: DataFrame, columns: list[str], by: list[str] = ["entity"],
                      period: str = "period", bounded: bool = False) -> DataFrame:
    """Mean, median, sample std, min, max and latest per column.

    ``latest`` is the value of the last row, even if it is missing.  ``bounded``
    promises groups of limited size (see ``choose_segments``): the median then
    joins the one aggregate; otherwise it is found without gathering a group.
    """
    if bounded:
        return _statistics(df, columns, by, period, {"median": F.median})
    basic = _statistics(df, columns, by, period, {})
    medians = exact_median(melt(df, by, columns, name="column"), [*by, "column"])
    return basic.join(medians, [*by, "column"], "left").select(
        *_keys(by), "column", "mean", "median", "std", "min", "max", "latest"
    )


def _statistics(df: DataFrame, columns: list[str], by: list[str], period: str,
                extra: dict) -> DataFrame:
    stats = ["mean", *extra, "std", "min", "max", "latest"]
    wide = df.groupBy(*_keys(by)).agg(*[
        expr.alias(f"__{stat}{i}")
        for i, c in enumerate(columns)
        for stat, expr in (
            ("mean", F.avg(col(c))), ("std", F.stddev_samp(col(c))), ("min", F.min(col(c))),
            ("max", F.max(col(c))), ("latest", F.max_by(col(c).cast("double"), col(period))),
            *[(name, fn(col(c).cast("double"))) for name, fn in extra.items()],
        )
    ])
    return unpivot_row(wide, by, [
        {"column": F.lit(c), **{s: F.col(f"__{s}{i}").cast("double") for s in stats}}
        for i, c in enumerate(columns)
    ])


def period_statistics(df: DataFrame, columns: list[str], ranges: dict[str, tuple],
                      by: list[str] = [], period: str = "period") -> DataFrame:
    """Mean, min and max per column over named ``(start, end)`` period ranges.

    Ranges may overlap and either end may be None; one aggregate serves all.
    """
    def inside(bounds) -> Column:
        start, end = bounds
        hit = F.lit(True)
        if start is not None:
            hit = hit & (col(period) >= start)
        if end is not None:
            hit = hit & (col(period) <= end)
        return hit

    aggs, cells = [], []
    for r, (label, bounds) in enumerate(ranges.items()):
        for i, c in enumerate(columns):
            value = F.when(inside(bounds), col(c)).cast("double")
            aggs += [F.avg(value).alias(f"__a{r}_{i}"), F.min(value).alias(f"__l{r}_{i}"),
                     F.max(value).alias(f"__h{r}_{i}")]
            cells.append({"range": F.lit(label), "column": F.lit(c),
                          "mean": F.col(f"__a{r}_{i}"), "min": F.col(f"__l{r}_{i}"),
                          "max": F.col(f"__h{r}_{i}")})
    return unpivot_row(df.groupBy(*_keys(by)).agg(*aggs), by, cells)


def overview(df: DataFrame, target: str, by: list[str] = [], period: str = "period") -> DataFrame:
    """Row count, first and last period, mean and sample std of the target."""
    return df.groupBy(*_keys(by)).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(col(period)).alias("first_period"),
        F.max(col(period)).alias("last_period"),
        F.avg(col(target)).alias("mean"),
        F.stddev_samp(col(target)).alias("std"),
    )


def pair_correlations(df: DataFrame, pairs: list[tuple[str, str]],
                      by: list[str] = []) -> DataFrame:
    """``a, b, corr`` for the given column pairs, pairwise complete.

    Up to 250 pairs are one aggregate with partial sums map-side.  More pairs of the
    whole table come from blocks of matrix products, one scan whatever their number
    (see ``crossprod``); per group (``by``) they take one pass per 250 pairs.
    """
    if len(pairs) > PAIRS_PER_AGGREGATE and not by:
        return _from_blocks(df, pairs)
    parts = []
    for start in range(0, len(pairs), PAIRS_PER_AGGREGATE):
        tile = pairs[start:start + PAIRS_PER_AGGREGATE]
        wide = df.groupBy(*_keys(by)).agg(*[
            pair_corr(col(a).cast("double"), col(b).cast("double")).alias(f"__c{i}")
            for i, (a, b) in enumerate(tile)
        ])
        parts.append(unpivot_row(wide, by, [
            {"a": F.lit(a), "b": F.lit(b), "corr": F.col(f"__c{i}")}
            for i, (a, b) in enumerate(tile)
        ]))
    return union_all(parts)


def _from_blocks(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """The wanted pairs out of all pairs of the columns that occur, in the given orientation."""
    columns = list(dict.fromkeys(c for pair in pairs for c in pair))
    place = {c: i for i, c in enumerate(columns)}
    every = blocked_correlations(df, columns)
    if len(set(pairs)) == len(columns) * (len(columns) + 1) // 2 and all(place[a] <= place[b] for a, b in pairs):
        return every
    wanted = df.sparkSession.createDataFrame(
        [(a, b, *((a, b) if place[a] <= place[b] else (b, a))) for a, b in dict.fromkeys(pairs)],
        "a string, b string, first string, second string")
    found = every.select(F.col("a").alias("first"), F.col("b").alias("second"), "corr")
    return wanted.join(found, ["first", "second"]).select("a", "b", "corr")


def correlation_matrix(df: DataFrame, columns: list[str], by: list[str] = []) -> DataFrame:
    """Full symmetric matrix as rows ``(a, b, corr)``; the diagonal comes from the data too."""
    upper = pair_correlations(df, [*combinations(columns, 2), *[(c, c) for c in columns]], by)
    there, back = (F.struct(F.col(x).alias("a"), F.col(y).alias("b"), "corr") for x, y in ("ab", "ba"))
    both = F.explode(F.when(F.col("a") == F.col("b"), F.array(there)).otherwise(F.array(there, back)))
    return upper.select(*_keys(by), both.alias("pair")).select(*_keys(by), "pair.a", "pair.b", "pair.corr")


def target_correlations(df: DataFrame, target: str, features: list[str],
                        by: list[str] = []) -> DataFrame:
    """Signed and absolute correlation of each feature with the target, weakest first.

    Features that never share a row with the target are left out.
    """
    aggs, cells = [], []
    y = col(target).cast("double")
    for i, f in enumerate(features):
        x = col(f).cast("double")
        aggs += [pair_corr(x, y).alias(f"__c{i}"),
                 F.count(F.when(x.isNotNull() & y.isNotNull(), 1)).alias(f"__n{i}")]
        cells.append({"feature": F.lit(f), "correlation": F.col(f"__c{i}"),
                      "n": F.col(f"__n{i}")})
    long = unpivot_row(df.groupBy(*_keys(by)).agg(*aggs), by, cells)
    return (
        long.filter("n > 0")
        .select(*_keys(by), "feature", "correlation", F.abs("correlation").alias("abs_correlation"))
        .orderBy(*_keys(by), "abs_correlation", "feature")
    )


def correlation_report(df: DataFrame, target: str, columns: list[str],
                       threshold: float = 0.90) -> DataFrame:
    """All columns (target included, = 1) by absolute correlation, strong ones flagged.

    Flagged rows are the suspected leaks; ``.limit(10)`` is the top ten.
    """
    return (
        target_correlations(df, target, columns)
        .select("feature", "abs_correlation",
                F.coalesce(F.col("abs_correlation") >= threshold, F.lit(False)).alias("suspect"))
        .orderBy(F.desc_nulls_last("abs_correlation"), "feature")
    )


def best_and_worst(metrics: DataFrame) -> DataFrame:
    """Best and worst value and model per metric; metrics that are all null are skipped."""
    names = [m for m in [*LOWER_IS_BETTER, *HIGHER_IS_BETTER] if m in metrics.columns]
    long = melt(metrics, ["model"], names, name="metric").filter("value is not null")
    lower = F.col("metric").isin(LOWER_IS_BETTER)
    low, high = F.min("value"), F.max("value")
    # Ties go to the first model name.
    low_model = F.min_by("model", F.struct("value", "model"))
    high_model = F.min_by("model", F.struct(-F.col("value"), F.col("model")))
    per = long.groupBy("metric").agg(
        low.alias("low"), high.alias("high"), low_model.alias("low_model"),
        high_model.alias("high_model"),
    )
    return per.select(
        "metric",
        F.when(lower, F.col("low")).otherwise(F.col("high")).alias("best"),
        F.when(lower, F.col("low_model")).otherwise(F.col("high_model")).alias("best_model"),
        F.when(lower, F.col("high")).otherwise(F.col("low")).alias("worst"),
        F.when(lower, F.col("high_model")).otherwise(F.col("low_model")).alias("worst_model"),
    )


def prediction_summary(predictions: DataFrame, by: list[str] = ["method"],
                       value: str = "prediction") -> DataFrame:
    """Mean, median, lowest (optimistic), highest (pessimistic) and sample std per group."""
    basic = predictions.groupBy(*_keys(by)).agg(
        F.avg(col(value)).alias("mean"), F.min(col(value)).alias("optimistic"),
        F.max(col(value)).alias("pessimistic"), F.stddev_samp(col(value)).alias("std"),
    )
    medians = exact_median(predictions.select(*_keys(by), col(value).alias("value")), by)
    return basic.join(medians, by, "left").select(
        *_keys(by), "mean", "median", "optimistic", "pessimistic", "std"
    )


def expected_change(predictions: DataFrame, panel: DataFrame, target: str,
                    since: int | None = 2020, by: list[str] = ["entity"],
                    value: str = "prediction", period: str = "period") -> DataFrame:
    """Average prediction against the latest known target: change, percent, direction.

    ``current`` is the target of the last row from ``since`` on, per entity.
    """
    recent = panel if since is None else panel.filter(col(period) >= since)
    current = recent.groupBy(*_keys(by)).agg(
        F.max_by(col(target).cast("double"), col(period)).alias("current")
    )
    average = predictions.groupBy(*_keys(by)).agg(F.avg(col(value)).alias("avg_prediction"))
    change = F.col("avg_prediction") - F.col("current")
    return average.join(current, by).select(
        *_keys(by), "current", "avg_prediction", change.alias("change"),
        (F.try_divide(change, F.col("current")) * 100).alias("change_pct"),
        F.when(change > 0, "increase").when(change < 0, "decrease")
        .when(change.isNotNull(), "stable").alias("direction"),
    )
