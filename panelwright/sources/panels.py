"""Wide panels on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from panelwright.functions.numeric import col, to_number, to_period


def read_panel(spark: SparkSession, path: str, fmt: str = "parquet", period: str = "Year",
               entity_cols: list[str] | None = None, entity_types: dict[str, str] | None = None) -> DataFrame:
    """Read a wide panel: keys first, integer period (bad ones NULL), numeric rest.

    CSV columns arrive as text and are converted leniently, so the schema comes
    from the header alone.  Row order is left to the consumer.  ``entity_types``
    declares keys that are folder names: left to Spark, a folder ``entity=007``
    is read as the number 7.
    """
    keys = list(entity_cols or [])
    if fmt == "csv":
        df = spark.read.option("header", True).option("comment", "#").csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    if entity_types:
        declared = T.StructType([
            T.StructField(f.name, T._parse_datatype_string(entity_types[f.name]) if f.name in entity_types else f.dataType)
            for f in df.schema
        ])
        reader = spark.read.schema(declared)
        df = (reader.option("header", True).option("comment", "#") if fmt == "csv" else reader).format(fmt).load(path)
    values = [c for c in df.columns if c not in keys and c != period]
    return df.select(
        *[col(k) for k in keys],
        to_period(col(period)).alias("period"),
        *[to_number(col(c)).alias(c) for c in values],
    )


def write_panel(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    """Write a wide panel.

    ``partition_by`` suits low-cardinality entities only.  Rows are rebalanced by
    folder: adaptive execution writes a hot folder with several tasks and several
    small ones with one, by the session's advisory partition size.
    """
    writer_input = df.hint("rebalance", *[col(c) for c in partition_by]) if partition_by else df
    writer = writer_input.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
