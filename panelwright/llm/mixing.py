"""Mixing sources to target weights by systematic sampling.

Within a source every document has the same expected number of copies.  Their
prefix sum, shifted by one random offset, is emitted at each integer it crosses.
Documents stand in order of size, so the words taken from a source differ from
its target by no more than the size of its largest document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import WORD, fresh
from panelwright.session import materialize


def source_targets(sizes: DataFrame, weights: Sequence[float] = (1, 2, 3), max_repeat: float = 3.0) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) per source.

    Sources by code point, null last, take the weights in turn and share the sum
    of all sizes; a target stops at ``max_repeat`` times its source's size and the
    excess is shared anew by weight until none is above.  The sources that stop
    are the first ones in order of size per weight, which gives the level of the
    others in closed form.  One row per source goes through one window: the table
    of sources is the mixture's configuration.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = sizes.withColumn("place", F.row_number().over(by_name) - 1)
    rows = rows.withColumn("weight", F.get(cycle, F.pmod("place", F.lit(len(weights)))))
    rows = rows.withColumn("cap", F.col("source_size") * F.lit(float(max_repeat)))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    rows = rows.withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    rows = rows.withColumn("shared", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    level = F.col("left") / F.col("shared")
    rows = rows.withColumn("level", F.when(level * F.col("weight") <= F.col("cap"), level))
    rows = rows.withColumn("level", F.first("level", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.select("source", "source_size",
                       F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.col("level") * F.col("weight")).alias("target"))


def mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), max_repeat: int = 3, seed: int = 17,
        keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with size, source_size, target and copies in a struct ``mixed``.

    ``keep`` names the columns to carry along (None: all).  The struct has
    another name if the table has that one.  size counts the words
    of the whole text, a null text has none.  A null source is a source of its
    own, a null doc_id sorts first; repeated rows are sampled one by one.  A
    source without words has target 0 and no copies.  The offset of a source comes
    from its name and ``seed``, and rows of one doc_id and size stand in the order
    of a hash of their texts, so reruns agree.  An empty table stays empty.

    Rows are dealt by ranges of (source, size, doc_id), so a source that holds a
    third of them lies in many partitions; one count per partition and source is
    summed to give each row its place.  The dealt rows are stored, so lost tasks
    read the same places again.
    """
    spark = docs.sparkSession
    mixed = fresh(docs, "mixed")
    own = docs.columns if keep is None else list(keep)
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    rows = docs.select(F.struct(*own).alias("row"), size.alias("size"), F.col("source").alias("source"), F.col("doc_id").alias("doc_id"),
                       F.xxhash64("text").alias("tie"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (rows.repartitionByRange(parts, "source", "size", "doc_id").sortWithinPartitions("source", "size", "doc_id", "tie")
            .drop("tie").withColumn("pos", F.monotonically_increasing_id()))
    rows = materialize(rows, "mix").withColumn("chunk", F.shiftright("pos", 33))
    counts = materialize(rows.groupBy("source", "chunk").agg(
        F.count("*").alias("n"), F.min("pos").alias("first"), F.sum("size").alias("words")), "mix-counts")
    targets = source_targets(counts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_repeat)
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    start = counts.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first"))
    start = start.select(F.col("source").alias("s"), F.col("chunk").alias("c"), "start")
    targets = targets.select(F.col("source").alias("t"), "source_size", "target")
    places = start.join(targets, F.col("s").eqNullSafe(F.col("t"))).drop("t")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # 16 bits of the offset: sums of a place and an offset stay exact
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    offset = F.conv(F.substring(F.md5(name.cast("binary")), 1, 4), 16, 10).cast("double") / 65536
    k = (F.col("pos") + F.col("start")).cast("double")
    crossed = F.floor(rate * (k + 1) + offset) - F.floor(rate * k + offset)
    out = rows.join(places, F.col("source").eqNullSafe(F.col("s")) & (F.col("chunk") == F.col("c")))
    return out.select("row.*", F.struct(
        "size", "source_size", "target", F.least(crossed, F.lit(max_repeat)).cast("long").alias("copies")).alias(mixed))


def emit(mixed: DataFrame, name: str = "mixed") -> DataFrame:
    """The mixture itself: every document as often as it is taken, without the struct."""
    often = F.explode(F.array_repeat(F.lit(1), F.col(f"{name}.copies").cast("int")))
    once = fresh(mixed, "once")
    return mixed.withColumn(once, often).drop(once, name)
