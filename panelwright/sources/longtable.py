"""Long indicator tables: reading, row filters, layout detection."""

from __future__ import annotations

import re
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.functions.numeric import col, name_key, to_number, to_period
from panelwright.operators.reshape import pivot_mean

# Header of a long indicator file, in file order.
RAW_HEADER = [
    "Country Name", "Country Code", "Indicator Name", "Indicator Code", "Year", "Value",
]
# Fixed value: entity text of an embedded metadata row.
METADATA_ENTITY = "#country+name"

RAW_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in RAW_HEADER])


# Bits of an order number that hold the place in a file; the rest hold the file's rank.
PLACE_BITS = 40


def read_long(spark: SparkSession, path, fmt: str = "csv", ordinal: str | None = None, multiline: bool = False) -> DataFrame:
    """Read a long file as text columns, with its row order as the number ``ordinal``.

    CSV: nothing is inferred; lines starting with ``#`` are comments, a quote inside
    quotes is doubled, a backslash is itself.  The order
    is (file name, place in the file) packed into one number, at every number and
    size of files: up to 8 million files of 1 TB.  It is exact when many tasks read
    a file: a split starts at a known byte, and the rows a task has read so far are
    fewer than the bytes of its splits.

    ``multiline`` reads cells with line ends inside quotes.  A file is then read by
    one task.  Without it such a cell tears its row; ``dropped_rows`` finds those.

    Other formats keep their own types and are turned into text here.  Encoded
    rows have no place in bytes, so their order must be stored: ``ordinal`` names
    that column.  Without it the result has no ``ordinal``.
    """
    if fmt != "csv":
        raw = spark.read.format(fmt).load(path)
        return raw.select(*[col(c).cast("string").alias(c) for c in RAW_HEADER],
                          *([col(ordinal).alias("ordinal")] if ordinal else []))
    raw = (spark.read.schema(RAW_SCHEMA).option("header", True).option("enforceSchema", False)
           .option("comment", "#").option("escape", '"').option("multiLine", multiline).csv(path))
    # the list writes file:///x where a row's metadata has file:/x
    names = sorted(re.sub("^([^:/]+):///", r"\1:/", f) for f in raw.inputFiles())
    if len(names) >= 1 << (63 - PLACE_BITS):
        raise ValueError(f"{len(names)} files have no order number")
    # an Arrow table has a known size, so Spark broadcasts it while it is small
    ranks = spark.createDataFrame(pa.table({"__file": pa.array(names, pa.string()), "__rank": pa.array(range(len(names)), pa.int64())}))
    read_so_far = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    rows = raw.select("*", F.regexp_replace("_metadata.file_path", "^([^:/]+):///", "$1:/").alias("__file"), (F.col("_metadata.file_block_start") + read_so_far).alias("__place"))
    known = F.coalesce("__rank", F.raise_error(F.concat(F.lit("file without a rank: "), F.col("__file"))).cast("long"))
    number = F.shiftleft(known, PLACE_BITS).bitwiseOR(F.col("__place"))
    return rows.join(ranks, "__file", "left").select(*[col(c) for c in RAW_HEADER], number.alias("ordinal"))


def dropped_rows(raw: DataFrame) -> DataFrame:
    """The rows that ``canonical_long`` leaves out, with a ``reason``.

    ``torn``: a cell holds an odd number of quotes, as when a quoted line end was
    read without ``multiline``; ``no_period``: the year is no number.  Torn rows
    that have a period are kept by ``canonical_long``, and are listed here too.
    """
    odd = F.lit(False)
    for c in RAW_HEADER:
        odd = odd | (F.coalesce(F.length(col(c)) - F.length(F.replace(col(c), F.lit('"'))), F.lit(0)) % 2 == 1)
    reason = F.when(odd, "torn").when(to_period(col("Year")).isNull(), "no_period")
    return raw.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def canonical_long(raw: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """Text columns to the canonical long panel; rows without a period are dropped.

    ``entity_key`` is the normalised name.  Store it: a filter on it is pushed
    to the scan, a filter on ``lower(trim(..))`` is not.
    """
    cleaned = raw.select(
        col("Country Name").alias("entity"),
        name_key(col("Country Name")).alias("entity_key"),
        col("Country Code").alias("entity_code"),
        col("Indicator Name").alias("indicator"),
        col("Indicator Code").alias("indicator_code"),
        to_period(col("Year")).alias("period"),
        to_number(col("Value")).alias("value"),
        *([col(ordinal).alias("ordinal")] if ordinal in raw.columns else []),
    )
    return cleaned.filter(F.col("period").isNotNull())


def entity_is(name: str, column: str = "entity") -> Column:
    """Case- and space-insensitive equality."""
    return name_key(col(column)) == name.strip().lower()


def entity_contains(text: str, column: str = "entity") -> Column:
    """Looser form: name contains ``text``, or is missing."""
    return col(column).contains(text) | col(column).isNull()


def drop_metadata_rows(df: DataFrame, column: str = "entity",
                       marker: str = METADATA_ENTITY) -> DataFrame:
    """Remove embedded metadata rows; rows with a missing name are kept."""
    return df.filter(~col(column).eqNullSafe(F.lit(marker)))


def indicators_in(df: DataFrame, names: list[str], column: str = "indicator") -> DataFrame:
    return df.filter(col(column).isin(list(names)))


def indicators_like(df: DataFrame, text: str, column: str = "indicator") -> DataFrame:
    """Case-insensitive name search; a missing name never matches."""
    return df.filter(F.lower(col(column)).contains(text.lower()))


def is_long_layout(df: DataFrame) -> bool:
    return {"indicator name", "year", "value"} <= {c.lower() for c in df.columns}


def to_panel(df: DataFrame, entity_text: str | None = None, indicators: list[str] | None = None,
             entity_cols: list[str] | None = None) -> DataFrame:
    """Long or wide table, told apart by column names, to a wide numeric panel."""
    by_lower = {c.lower(): c for c in df.columns}
    keys = list(entity_cols or [])
    if is_long_layout(df):
        if entity_text is not None and "country name" in by_lower:
            df = df.filter(entity_contains(entity_text, by_lower["country name"]))
        long = df.select(
            *[col(k) for k in keys],
            to_period(col(by_lower["year"])).alias("period"),
            col(by_lower["indicator name"]).alias("indicator"),
            to_number(col(by_lower["value"])).alias("value"),
        ).filter(F.col("period").isNotNull())
        return pivot_mean(long, entity_cols=keys, indicators=indicators)
    period = by_lower.get("year") or by_lower.get("period")
    values = [c for c in df.columns if c != period and c not in keys]
    return df.select(
        *[col(k) for k in keys],
        *([to_period(col(period)).alias("period")] if period else []),
        *[to_number(col(c)).alias(c) for c in values],
    )


def read_any(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The first readable candidate, header only - no type inference pass."""
    failures = []
    for path in paths:
        try:
            if path.endswith(".parquet"):
                return spark.read.parquet(path)
            return spark.read.option("header", True).csv(path)
        except AnalysisException as missing:
            failures.append(f"{path}: {missing.getCondition()}")
    raise FileNotFoundError("no readable candidate: " + "; ".join(failures))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
