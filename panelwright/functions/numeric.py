"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def q(name: str) -> str:
    """Back-quote a column name so dots, spaces and percent signs are safe."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(q(name))


def nan_to_null(c: Column) -> Column:
    """NaN sorts above every number in Spark, so missing is always NULL here."""
    return F.when(~F.isnan(c), c)


def to_number(c: Column) -> Column:
    """Lenient number: unparsable text and NaN become NULL, never an error."""
    return nan_to_null(c.try_cast("double"))


def to_period(c: Column) -> Column:
    """Lenient integer period; ``'2000.0'`` and ``2000.9`` both give 2000."""
    return to_number(c).try_cast("int")


def stripped(c: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def name_key(c: Column) -> Column:
    """Comparison form of an entity name."""
    return F.lower(stripped(c))


def pair_corr(a: Column, b: Column) -> Column:
    """Pearson correlation over rows where both sides are present.

    A constant side gives NULL instead of the division error that ``corr``
    raises under ANSI mode.
    """
    both_a = F.when(b.isNotNull(), a)
    both_b = F.when(a.isNotNull(), b)
    return F.try_divide(
        F.covar_pop(a, b), F.stddev_pop(both_a) * F.stddev_pop(both_b)
    )


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] | list[str] = ()) -> list[str]:
    """Names of numeric columns in schema order, without ``exclude``."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in set(exclude)
    ]


def present(df: DataFrame, names) -> list[str]:
    """The subset of ``names`` that exists in ``df``, in the order of ``names``."""
    have = set(df.columns)
    return [n for n in names if n in have]


def melt(df: DataFrame, keys: list[str], columns: list[str],
         name: str = "indicator", value: str = "value") -> DataFrame:
    """Wide to long, keeping rows whose value is NULL."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias(name), col(c).cast("double").alias(value)) for c in columns
    ])
    return (
        df.select(*[col(k) for k in keys], F.explode(pairs).alias("__cell"))
        .select(*[col(k) for k in keys],
                F.col(f"__cell.{name}").alias(name),
                F.col(f"__cell.{value}").alias(value))
    )
