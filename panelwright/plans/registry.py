"""Registration of runnable queries with their oracle SQL and blueprint ids."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.functions.numeric import col


@dataclass
class Registered:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    covers: str


REGISTRY: dict[str, Registered] = {}


def query(covers: str, sql: str | None = None):
    """Register a function under its own name; double columns are rounded to 6 places."""
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(spark, sf_dir), as_sql=sql is not None and repr(NUDGE) in sql)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[fn.__name__] = Registered(run, sql, covers)
        return fn
    return wrap


# Added before rounding on both sides, so that values lying exactly between two
# roundings do not depend on the last bit of a sum.
NUDGE = 1.23e-8


def rounded(df: DataFrame, digits: int = 6, as_sql: bool = False) -> DataFrame:
    """Double columns to ``digits`` places.

    ``as_sql``: the SQL rounds as well, by whole multiples of 10^-digits in binary; that
    moves the last bit of numbers above 2^53 such multiples, so it is done alike here.
    """
    def of(c):
        moved = c + NUDGE
        if not as_sql:
            return F.round(moved, digits)
        scale = F.lit(10.0 ** digits)
        whole = F.round(moved * scale, 0) / scale
        return F.when(F.abs(whole) < float("inf"), whole).otherwise(moved)

    return df.select(*[
        of(col(f.name)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else col(f.name)
        for f in df.schema.fields
    ])
