"""Exact quantiles that never gather a large group in one place."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.numeric import col

# The sketch answers within 1/ACCURACY of the rank; the bracket is far wider.
ACCURACY = 10_000
MARGIN = 0.001
ZONES = 64
# Groups of up to this many rows are gathered; the others, at most one in this many rows, are broadcast.
SMALL_GROUP = 10_000


def meet(rows: DataFrame, few: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined where they are with the broadcast ``few``; a null key equals a null key."""
    named = few.withColumnsRenamed({k: f"__k{i}" for i, k in enumerate(keys)})
    same = reduce(and_, [col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
    return rows.join(F.broadcast(named), same, how).drop(*named.columns[:len(keys)])


def exact_median(cells: DataFrame, keys: list[str], value: str = "value",
                 name: str = "median") -> DataFrame:
    """Median of ``value`` per ``keys`` (mean of the two middle values for even counts).

    1. A sketch per key gives two values that enclose the middle ranks.  The
       sketches of groups with more than SMALL_GROUP rows are broadcast; the
       other groups have their median from one aggregate.
    2. Rows of a large group meet its bracket where they are read: those above
       are dropped, those below just counted, and only those inside it (about
       0.2 percent of the ranks) are shuffled, equal values as one row.
    3. They are cut into ZONES zones of about equal size.  Counts per zone tell
       which zones hold the middle ranks, and only these are ordered, each in a
       task of its own: at most about 0.2 percent / ZONES of a group's rows.
    """
    if not keys:
        raise ValueError("exact_median needs at least one key column")
    filled = cells.filter(col(value).isNotNull()).select(*[col(k) for k in keys], col(value).alias("__v"))
    bracket = filled.groupBy(*[col(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("__n"),
        F.percentile_approx("__v", F.array(F.lit(0.5 - MARGIN), F.lit(0.5 + MARGIN)),
                            F.lit(ACCURACY)).alias("__b"),
    ).filter(F.col("__n") > SMALL_GROUP).select(
        *[col(k) for k in keys], "__n", F.col("__b")[0].alias("__lo"), F.col("__b")[1].alias("__hi"))
    small = meet(filled, bracket, keys, "left_anti").groupBy(*[col(k) for k in keys]).agg(
        F.median("__v").alias(name))
    placed = meet(filled, bracket, keys)
    # Values below the bracket shrink to one row per key and map task.
    below = F.col("__v") < F.col("__lo")
    kept = (
        placed.filter(F.col("__v") <= F.col("__hi"))
        .groupBy(*[col(k) for k in keys], "__n", F.when(below, F.col("__lo")).otherwise(F.col("__v")).alias("__v"))
        .agg(F.count_if(below).alias("__under"), F.count_if(~below).alias("__at"))
    )
    cuts = kept.filter("__at > 0").groupBy(*[col(k) for k in keys]).agg(F.percentile_approx(
        "__v", F.array(*[F.lit(i / ZONES) for i in range(1, ZONES)]), F.lit(ACCURACY)).alias("__cuts"))
    zoned = meet(kept, cuts, keys).withColumn(
        "__zone", F.size(F.filter("__cuts", lambda c: c < F.col("__v")))).drop("__cuts")
    earlier = Window.partitionBy(*[col(k) for k in keys]).orderBy("__zone").rowsBetween(Window.unboundedPreceding, -1)
    sizes = zoned.groupBy(*[col(k) for k in keys], "__n", "__zone").agg(F.sum(F.col("__under") + F.col("__at")).alias("__size"))
    sizes = sizes.withColumn("__before", F.coalesce(F.sum("__size").over(earlier), F.lit(0)))
    low_rank = F.floor((F.col("__n") + 1) / 2)
    high_rank = F.floor(F.col("__n") / 2) + 1
    reached = (F.col("__before") < high_rank) & (F.col("__before") + F.col("__size") >= low_rank)
    middle_zones = sizes.filter(reached).select(*[col(k) for k in keys], "__zone", "__before")
    w = Window.partitionBy(*[col(k) for k in keys], "__zone").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = meet(zoned, middle_zones, [*keys, "__zone"]).select(
        *[col(k) for k in keys], "__n", "__v", "__at",
        (F.col("__before") + F.sum(F.col("__under") + F.col("__at")).over(w)).alias("__upto"),
    )
    first = F.col("__upto") - F.col("__at") + 1

    def holds(rank):
        return (first <= rank) & (rank <= F.col("__upto")) & (F.col("__at") > 0)

    middle = ranked.groupBy(*[col(k) for k in keys]).agg(
        F.max(F.when(holds(low_rank), F.col("__v"))).alias("__a"),
        F.max(F.when(holds(high_rank), F.col("__v"))).alias("__z"),
    )
    missed = F.raise_error(F.lit("median bracket missed the middle rank")).cast("double")
    large = middle.select(*[col(k) for k in keys], F.coalesce(
        (F.col("__a") + F.col("__z")) / 2, missed
    ).alias(name))
    return small.unionByName(large)
