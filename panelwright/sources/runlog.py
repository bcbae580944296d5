"""Append-only log of experiment runs: parameters and metrics."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.sources.files import path_exists

RUN_SCHEMA = ("experiment string, run_id string, started bigint, kind string, key string, "
              "value_str string, value_dbl double, step int")


def flatten(config: dict, prefix: str = "") -> dict[str, Any]:
    """Nested keys joined by dots."""
    flat: dict[str, Any] = {}
    for key, value in config.items():
        name = f"{prefix}.{key}" if prefix else str(key)
        if isinstance(value, dict):
            flat.update(flatten(value, name))
        else:
            flat[name] = value
    return flat


def run_entries(spark: SparkSession, experiment: str, run_id: str, started: int,
                params: dict | None = None, metrics: dict[str, float] | None = None,
                step: int = 0) -> DataFrame:
    rows = [(experiment, run_id, started, "param", k, str(v), None, None)
            for k, v in flatten(params or {}).items()]
    rows += [(experiment, run_id, started, "metric", k, None, float(v), step)
             for k, v in (metrics or {}).items()]
    return spark.createDataFrame(rows, RUN_SCHEMA)


def append_runs(entries: DataFrame, path: str) -> None:
    entries.write.mode("append").partitionBy("experiment").parquet(path)


def read_runs(spark: SparkSession, path: str, experiment: str) -> DataFrame:
    """Entries of one experiment (only its folder is read); an unknown one is empty."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], RUN_SCHEMA)
    return spark.read.schema(RUN_SCHEMA).parquet(path).filter(F.col("experiment") == experiment)


def best_run(entries: DataFrame, metric: str, mode: str = "max",
             by: list[str] = ["experiment"]) -> DataFrame:
    """Run with the best last value of ``metric``; the earliest run wins a tie.

    Two aggregates, both combined map-side; runs without the metric drop out.
    """
    if mode not in ("max", "min"):
        raise ValueError("mode must be 'max' or 'min'")
    logged = entries.filter((F.col("kind") == "metric") & (F.col("key") == metric)
                            & F.col("value_dbl").isNotNull())
    per_run = logged.groupBy(*by, "run_id", "started").agg(
        F.max_by("value_dbl", "step").alias("value"))
    signed = -F.col("value") if mode == "max" else F.col("value")
    order = F.struct(signed.alias("v"), F.col("started"), F.col("run_id"))
    return per_run.groupBy(*by).agg(
        F.min_by("run_id", order).alias("run_id"), F.min_by("value", order).alias("value"))
