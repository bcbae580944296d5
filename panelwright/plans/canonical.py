"""Panels derived from the sample tables: the inputs of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.operators.columns import add_year_column
from panelwright.operators.ordered import choose_segments, fill_missing
from panelwright.operators.reshape import pivot_first
from panelwright.session import materialize

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
EVENT_DAY_ZERO = "2024-01-01"
ORDER_YEAR_ZERO = 1995
THOUSAND = 1e3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity = user, period = day, indicator = event type, value, ordinal = event id."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("entity"),
        F.datediff(F.to_date("ts"), F.lit(EVENT_DAY_ZERO).cast("date")).alias("period"),
        F.col("event_type").alias("indicator"),
        F.col("value"),
        F.col("event_id").alias("ordinal"),
    )


def events_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_first(events_long(spark, sf_dir), indicators=EVENT_TYPES)


def events_segments(spark: SparkSession, sf_dir: str) -> int | None:
    """One look at the day range decides how series are cut; it reads a single column."""
    return choose_segments(events_long(spark, sf_dir).select("period"))


#: What the models use; nothing else decides whether a user stays.
MODEL_TYPES = ["click", "error", "view"]


def events_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filled panel of MODEL_TYPES with the year feature; series that never occur stay out."""
    panel = events_panel(spark, sf_dir).select("entity", "period", *MODEL_TYPES)
    return add_year_column(
        fill_missing(panel, segment_rows=events_segments(spark, sf_dir)).dropna())


def events_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filled panel as a table: model fitting passes over it many times, the raw events once."""
    return materialize(events_filled(spark, sf_dir), "events-filled")


def events_panel_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide panel as a table, the form a scoring service reads."""
    return materialize(events_panel(spark, sf_dir), "events-panel")


def order_segments(spark: SparkSession, sf_dir: str) -> int | None:
    months = table(spark, sf_dir, "orders").select(month_index("o_orderdate").alias("period"))
    return choose_segments(months)


def month_index(column: str):
    c = F.col(column)
    return ((F.year(c) - ORDER_YEAR_ZERO) * 12 + F.month(c)).cast("int")


def orders_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity = market segment, period = month; counts, revenue and mean price (thousands), urgent share.

    Orders shrink to one row per customer and month before the join, so a
    customer with very many orders is no hot key.
    """
    per_customer = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", month_index("o_orderdate").alias("period"))
        .agg(
            F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"),
            F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
        )
    )
    segments = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("entity"))
    return per_customer.join(segments, "o_custkey").groupBy("entity", "period").agg(
        F.sum("n").alias("n_orders"),
        (F.sum("total") / THOUSAND).alias("revenue"),
        (F.sum("total") / F.sum("n") / THOUSAND).alias("mean_price"),
        (F.sum("urgent") / F.sum("n")).alias("urgent_share"),
    )


def lines_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity = return flag, period = ship month; gross, net and charged sums, quantity,
    mean discount and tax."""
    price, less, tax = F.col("l_extendedprice"), 1 - F.col("l_discount"), 1 + F.col("l_tax")
    return table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_returnflag").alias("entity"), month_index("l_shipdate").alias("period")
    ).agg(
        F.sum(price).alias("gross"),
        F.sum(price * less).alias("net"),
        F.sum(price * less * tax).alias("charged"),
        F.sum("l_quantity").alias("quantity"),
        F.avg("l_discount").alias("discount"),
        F.avg("l_tax").alias("tax"),
    )


LINE_INDICATORS = ["charged", "discount", "gross", "net", "quantity", "tax"]
ORDER_INDICATORS = ["mean_price", "n_orders", "revenue", "urgent_share"]
