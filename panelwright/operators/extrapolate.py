"""Trend extrapolation of indicators under four methods and two rules.

``last_step`` is the batch rule: the horizon counts from the ``last_period``
argument and exponential growth is the last step.  ``anchored`` is the serving
rule: the horizon counts from the last observed period of the indicator and
exponential growth is averaged over up to five observations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.numeric import col, melt

# Trend methods.
TREND_METHODS = ["linear", "exponential", "last_value", "average"]
RULES = ["last_step", "anchored"]
# Fixed value: observations a trend looks back.
LOOK_BACK = 5


def trend_table(panel: DataFrame, indicators: list[str], entity_cols: list[str] = ["entity"],
                period: str = "period", last_period: int | None = None) -> DataFrame:
    """One row per entity with all a trend needs; ``__t<i>_*`` belongs to ``indicators[i]``.

    Counts, means and extremes are map-side aggregates of the wide panel.  The
    last five observations come from a rank filter that Spark applies before
    the shuffle as well, so a hot entity sends five rows per indicator and map
    task, not its history.
    """
    history = panel if last_period is None else panel.filter(col(period) <= last_period)
    keys = [col(k) for k in entity_cols]
    totals = history.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n_rows"),
        *[e.alias(f"__t{i}_{n}") for i, c in enumerate(indicators) for n, e in (
            ("n", F.count(col(c))), ("mean", F.avg(col(c))),
            ("low", F.min(col(c)).cast("double")), ("high", F.max(col(c)).cast("double")))],
    )
    newest = Window.partitionBy(*keys, F.col("indicator")).orderBy(col(period).desc())
    recent = (
        melt(history, [*entity_cols, period], indicators)
        .filter("value is not null")
        .withColumn("__r", F.row_number().over(newest))
        .filter(F.col("__r") <= LOOK_BACK)
    )

    def mine(c: str, value: Column, rank: int | None = None) -> Column:
        hit = F.col("indicator") == c
        return F.when(hit if rank is None else hit & (F.col("__r") == rank), value)

    tails = recent.groupBy(*keys).agg(*[
        e.alias(f"__t{i}_{n}") for i, c in enumerate(indicators) for n, e in (
            ("last", F.max(mine(c, F.col("value"), 1))),
            ("previous", F.max(mine(c, F.col("value"), 2))),
            ("oldest", F.max_by("value", mine(c, F.col("__r")))),
            ("span", F.max(mine(c, F.col("__r")))),
            ("last_seen", F.max(mine(c, col(period)))),
        )
    ])
    return totals.join(tails, entity_cols, "left")


def trend_value(i: int, year: Column, method: Column, rule: str,
                last_period: int | None = None) -> Column:
    """Extrapolated value of the i-th indicator of a trend table at ``year``."""
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}")

    def f(name: str) -> Column:
        return F.col(f"__t{i}_{name}")

    slope = (f("last") - f("oldest")) / f("span")
    if rule == "last_step":
        if last_period is None:
            raise ValueError("rule 'last_step' needs last_period")
        horizon = (year - F.lit(last_period)).cast("double")
        growth = F.when((f("last") > 0) & (f("previous") > 0),
                        F.try_divide(f("last"), f("previous")))
        usable = (f("n") >= 2) & (f("low") < f("high"))
        fallback = f("last")
    else:
        horizon = (year - f("last_seen")).cast("double")
        ratio = F.when(f("oldest") > 0, F.try_divide(f("last"), f("oldest")))
        growth = F.pow(ratio, 1.0 / f("span"))
        usable = f("n") >= 2
        fallback = F.lit(None).cast("double")
    return F.when(
        usable,
        F.when(method == "linear", f("last") + slope * horizon)
        .when(method == "exponential",
              F.coalesce(f("last") * F.pow(growth, horizon), f("last")))
        .when(method == "average", f("mean"))
        .otherwise(f("last")),
    ).otherwise(fallback)


def scenario(panel: DataFrame, indicators: list[str], last_period: int, target_period: int,
             methods: list[str] = ["linear"], rule: str = "last_step",
             entity_cols: list[str] = ["entity"], period: str = "period",
             on_short: str = "raise") -> DataFrame:
    """Indicator values for each period after ``last_period`` up to ``target_period``.

    One output row per entity, period and method.  ``last_step`` reads periods
    up to ``last_period`` only.  Entities with fewer than two rows are an error
    (``raise``), get no scenario (``skip``) or the last value under every method
    (``last``).  Years and methods are unrolled after the last shuffle.
    """
    unknown = set(methods) - set(TREND_METHODS)
    if unknown:
        raise ValueError(f"unknown trend methods: {sorted(unknown)}")
    if target_period <= last_period:
        raise ValueError("target_period must be after last_period")
    if on_short not in ("raise", "skip", "last"):
        raise ValueError("on_short must be 'raise', 'skip' or 'last'")
    seen_to = last_period if rule == "last_step" else None
    wide = trend_table(panel, indicators, entity_cols, period, seen_to)
    if rule == "last_step" and on_short != "last":
        enough = F.col("__n_rows") >= 2
        if on_short == "skip":
            wide = wide.filter(enough)
        else:
            wide = wide.filter(F.when(enough, F.lit(True)).otherwise(
                F.raise_error(F.lit("fewer than two rows to extrapolate from")).cast("boolean")
            ))
    rows = wide.withColumn(
        period, F.explode(F.sequence(F.lit(last_period + 1), F.lit(target_period)))
    ).withColumn("method", F.explode(F.array(*[F.lit(m) for m in methods])))
    return rows.select(
        *[col(k) for k in entity_cols], col(period), "method",
        *[trend_value(i, col(period), F.col("method"), rule, last_period).alias(c)
          for i, c in enumerate(indicators)],
    )
