"""Scoring a stream of request files against a static panel and fitted models."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from panelwright.operators.contract import Contract, validate_requests
from panelwright.operators.scoring import (
    TOTALS_SCHEMA,
    ServingPanel,
    of_batch,
    score_requests,
    store_serving_panel,
    write_scored,
)
from panelwright.session import scratch_path


def request_stream(spark: SparkSession, folder: str, schema, fmt: str = "parquet",
                   files_per_batch: int = 100) -> DataFrame:
    """New request files of a folder; the rate per micro-batch is bounded."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
            .format(fmt).load(folder))


def start_scoring(requests: DataFrame, panel: DataFrame | ServingPanel, models: dict[str, PipelineModel],
                  contract: Contract, default_model: str, output: str, checkpoint: str,
                  entity_cols: list[str] = ["entity"], period: str = "period") -> StreamingQuery:
    """Score what has arrived, then stop.

    ``panel`` is a stored serving panel; a plain panel is stored as one, once, before
    the stream starts.  A micro-batch shuffles its own requests only, and reads of
    the panel what can hold its entities.

    Each micro-batch runs the batch plan, so stream and batch answers agree.
    A batch writes to its own folder and overwrites it when replayed, which
    makes the sink exactly-once; rejected requests and the batch's totals, counted
    while the answers are written, land beside the scored ones.
    """
    if not isinstance(panel, ServingPanel):
        path = scratch_path(panel.sparkSession, "serving")
        panel = store_serving_panel(panel, contract, f"serving_{path.rsplit('-', 1)[1]}", path, entity_cols, period)

    def handle(batch: DataFrame, number: int) -> None:
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        own = of_batch(panel, held, entity_cols)
        scored, rejected = score_requests(held, own.history, models, contract, default_model,
                                          entity_cols, period, own.trends)
        totals = write_scored(scored, rejected, f"{output}/scored/batch={number}", f"{output}/rejected/batch={number}", "overwrite")
        totals.write.mode("overwrite").parquet(f"{output}/totals/batch={number}")
        held.unpersist()

    return (requests.writeStream.foreachBatch(handle)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def validated_stream(requests: DataFrame, contract: Contract, models: list[str],
                     period: str = "period") -> DataFrame:
    """The stateless part alone: error codes on a live stream."""
    return validate_requests(requests, contract, models, period=period)


def read_scored(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.parquet(f"{output}/scored").drop("batch")


def read_rejected(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.parquet(f"{output}/rejected").drop("batch")


def read_totals(spark: SparkSession, output: str) -> DataFrame:
    """Requests in total, successful and failed, over all batches."""
    return spark.read.schema(TOTALS_SCHEMA).parquet(f"{output}/totals").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("total_predictions", "successful", "failed")])
