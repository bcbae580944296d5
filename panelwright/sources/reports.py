"""Result tables on disk: metrics, importance, tuning, forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.numeric import col
from panelwright.models.scores import IMPORTANCE_SCHEMA, METRICS_SCHEMA
from panelwright.operators.ensemble import last_known
from panelwright.sources.files import path_exists

PREDICTIONS_SCHEMA = "model string, prediction double, scenario_method string"


def metrics_table(spark: SparkSession, metrics: dict[str, dict[str, float]]) -> DataFrame:
    """``{model: {metric: value}}`` to one row per model."""
    rows = [(m, *[_float(v.get(k)) for k in ("MAE", "RMSE", "R2")]) for m, v in metrics.items()]
    return spark.createDataFrame(rows, METRICS_SCHEMA)


def _float(v):
    return None if v is None else float(v)


def importance_summary(tables: list[DataFrame]) -> DataFrame:
    """All importance tables together, by model and rank."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.orderBy("model", "rank")


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    writer = df.write.mode("overwrite").format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)


def read_report(spark: SparkSession, path: str, schema: str, fmt: str = "csv") -> DataFrame:
    """A report with a fixed schema; an absent path is an empty table."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).format(fmt)
    return (reader.option("header", True).option("enforceSchema", False)
            if fmt == "csv" else reader).load(path)


def read_metrics(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_report(spark, path, METRICS_SCHEMA, fmt)


def read_importance(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_report(spark, path, IMPORTANCE_SCHEMA, fmt)


def read_predictions(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_report(spark, path, PREDICTIONS_SCHEMA, fmt)


def forecast_report(predictions: DataFrame, panel: DataFrame, target: str, last_period: int,
                    entity_cols: list[str] = ["entity"], period: str = "period") -> DataFrame:
    """Prediction per entity, model and scenario beside the last known target and the data range."""
    history = panel.filter(col(period) <= last_period)
    facts = history.groupBy(*[col(k) for k in entity_cols]).agg(
        last_known(target, period).alias("current"),
        F.min(col(period)).alias("data_start"), F.max(col(period)).alias("data_end"))
    return (
        predictions.join(facts, entity_cols, "left")
        .select(*[col(k) for k in entity_cols], "model",
                col(period).alias("prediction_period"), "prediction",
                F.col("method").alias("scenario_method"),
                F.col("current").alias("last_value"), "data_start", "data_end")
    )
