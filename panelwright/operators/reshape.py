"""Long to wide reshaping and column profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.numeric import col

# Up to this many indicators one aggregate with a filtered expression per
# indicator is used: one shuffle on (entity, period).  Beyond it the generated
# code gets too large and Spark's own two-step pivot takes over.
MAX_FILTERED_AGGREGATES = 128
# A panel has one column per indicator; Spark's pivot has the same limit.
MAX_INDICATORS = 10_000


def list_indicators(long: DataFrame, indicator: str = "indicator") -> DataFrame:
    """Distinct indicator names, sorted."""
    return long.select(col(indicator).alias("indicator")).distinct().orderBy("indicator")


def indicator_names(long: DataFrame, indicator: str = "indicator") -> list[str]:
    """Indicator names on the driver: they become column names, so they must be few."""
    found = long.select(col(indicator).alias("indicator")).distinct().filter("indicator is not null")
    names = sorted(r[0] for r in found.limit(MAX_INDICATORS + 1).collect())
    if len(names) > MAX_INDICATORS:
        raise ValueError(f"more than {MAX_INDICATORS} indicators cannot become columns")
    return names


def _pivot(long: DataFrame, keys: list[str], names: list[str], indicator: str, one) -> DataFrame:
    """``one(value_filter)`` builds the aggregate of a single cell."""
    grouped = long.groupBy(*[col(k) for k in keys])
    if len(names) > MAX_FILTERED_AGGREGATES:
        return grouped.pivot(indicator, names).agg(one(F.lit(True)))
    return grouped.agg(*[one(col(indicator) == F.lit(n)).alias(n) for n in names])


def pivot_first(long: DataFrame, entity_cols: list[str] = ["entity"], period: str = "period",
                indicator: str = "indicator", value: str = "value", ordinal: str = "ordinal",
                indicators: list[str] | None = None) -> DataFrame:
    """Wide panel holding the first non-null value of each cell in ``ordinal`` order.

    Cells aggregate map-side, so a hot entity never travels row by row.
    Columns are sorted by name; all-null indicators and rows do not appear.
    """
    filled = long.filter(col(value).isNotNull())
    names = sorted(indicators) if indicators is not None else indicator_names(filled, indicator)

    def first_value(hit: Column) -> Column:
        return F.min_by(col(value), F.when(hit, col(ordinal)))

    return _pivot(filled.filter(col(indicator).isin(names)), [*entity_cols, period], names,
                  indicator, first_value)


def pivot_mean(long: DataFrame, entity_cols: list[str] = ["entity"], period: str = "period",
               indicator: str = "indicator", value: str = "value",
               indicators: list[str] | None = None) -> DataFrame:
    """Wide panel holding the mean of each cell."""
    filled = long.filter(col(value).isNotNull())
    names = sorted(indicators) if indicators is not None else indicator_names(filled, indicator)
    return _pivot(filled.filter(col(indicator).isin(names)), [*entity_cols, period], names,
                  indicator, lambda hit: F.avg(F.when(hit, col(value))))


def duplicate_cells(long: DataFrame, entity_cols: list[str] = ["entity"], period: str = "period",
                    indicator: str = "indicator") -> DataFrame:
    """Cells that occur more than once, with their row count."""
    keys = [*entity_cols, period, indicator]
    return (long.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter("n_rows > 1"))


def pivot_strict(long: DataFrame, entity_cols: list[str] = ["entity"], period: str = "period",
                 indicator: str = "indicator", value: str = "value",
                 indicators: list[str] | None = None) -> DataFrame:
    """Wide panel where a repeated cell is an error.

    The check rides in the same aggregate and fails the query that runs it; no
    extra pass over the data.
    """
    names = sorted(indicators) if indicators is not None else indicator_names(long, indicator)

    def only_value(hit: Column) -> Column:
        repeated = F.count(F.when(hit, F.lit(1))) > 1
        return F.when(
            repeated,
            F.raise_error(F.lit("a cell of the panel occurs more than once")).cast("double"),
        ).otherwise(F.max(F.when(hit, col(value))))

    return _pivot(long.filter(col(indicator).isin(names)), [*entity_cols, period], names,
                  indicator, only_value)


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct and null count per column.

    Distinct counting goes through (column, value) partial counts, so no single
    task holds all values of a column.
    """
    cells = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("v")) for c in columns
    ])).alias("x")).select("x.column", "x.v")
    per_value = cells.groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    return per_value.groupBy("column").agg(
        F.count("v").alias("distinct_count"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
    )


def null_fractions(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: fraction of missing values per column."""
    return df.agg(*[F.avg(F.isnull(col(c)).cast("double")).alias(c) for c in columns])


def drop_sparse_columns(df: DataFrame, threshold: float = 0.5,
                        keep: list[str] = ["entity", "period"],
                        target: str | None = None) -> DataFrame:
    """Keep columns whose missing fraction is at most ``threshold``.

    Keys are never dropped; a target that would be dropped is an error.
    """
    if not 0 <= threshold <= 1:
        raise ValueError("threshold must be between 0 and 1")
    candidates = [c for c in df.columns if c not in keep]
    if not candidates:
        return df
    fractions = null_fractions(df, candidates).first()
    sparse = {c for c, f in zip(candidates, fractions) if f is not None and f > threshold}
    if target in sparse:
        raise ValueError(f"target {target!r} is too sparse: {fractions[candidates.index(target)]:.3f}")
    return df.select(*[col(c) for c in df.columns if c not in sparse])
