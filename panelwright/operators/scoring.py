"""Scoring of request tables, scenarios and year ranges."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from panelwright.functions.numeric import col, present
from panelwright.models.scores import score_models, score_wide
from panelwright.operators.contract import Contract, split_valid, validate_requests
from panelwright.operators.extrapolate import trend_table, trend_value
from panelwright.session import scratch_path

# Upper bound, level and outlook of each band.
STRESS_BANDS = [
    (25.0, "low", "sustainable water availability"),
    (50.0, "low-medium", "manageable water situation with monitoring needed"),
    (75.0, "medium-high", "potential water scarcity concerns"),
    (100.0, "high", "significant water stress requiring intervention"),
    (None, "critical", "severe water scarcity - unsustainable situation"),
]

# Fixed value: text of a scenario answer (period, entity, level, prediction, outlook).
INTERPRETATION = (
    "By %d, %s is predicted to have %s water stress at %.1f%%. "
    "This indicates %s. "
    "Note: This prediction is based on historical trend extrapolation "
    "and assumes continuation of current patterns."
)

# Fixed value: note of a plain answer.
CONFIDENCE_NOTE = (
    "This prediction is based on historical patterns and should be interpreted with caution."
)


def prepare_features(df: DataFrame, expected: list[str], period: str = "period",
                     year: str = "year") -> tuple[DataFrame, list[str]]:
    """Add the year feature if it is expected, keep the expected order, report missing names."""
    if year in expected and year not in df.columns:
        df = df.withColumn(year, col(period).cast("int"))
    found = present(df, expected)
    others = [c for c in df.columns if c not in found]
    return (df.select(*[col(c) for c in [*others, *found]]),
            [c for c in expected if c not in found])


def usable_models(df: DataFrame, models: dict[str, PipelineModel]) -> tuple[dict, dict[str, str]]:
    """Models that accept this schema, and why the others do not."""
    good, bad = {}, {}
    for name, model in models.items():
        try:
            model.transform(df.limit(0)).schema  # analysis only, nothing runs
            good[name] = model
        except (AnalysisException, IllegalArgumentException) as e:
            bad[name] = str(e).splitlines()[0]
    return good, bad


def score_scenarios(scenarios: DataFrame, models: dict[str, PipelineModel], features: list[str],
                    target_period: int, entity_cols: list[str] = ["entity"],
                    period: str = "period") -> tuple[DataFrame, dict[str, str]]:
    """Prediction of every usable model for the target period of every scenario."""
    rows, _ = prepare_features(scenarios.filter(col(period) == target_period), features, period)
    good, failed = usable_models(rows, models)
    scored = score_models(rows, good, present(rows, features), keep=[*entity_cols, period, "method"])
    return scored, failed


# --- request defaults -----------------------------------------------------------


def request_trends(panel: DataFrame, contract: Contract, entity_cols: list[str] = ["entity"],
                   period: str = "period", asked: DataFrame | None = None) -> DataFrame:
    """Trend table of the contract's columns, for the entities of ``asked`` (None: all)."""
    if asked is not None:
        panel = panel.join(asked.select(*[col(c) for c in entity_cols]).distinct(), entity_cols, "left_semi")
    return trend_table(panel, [f.column for f in contract.features], entity_cols, period)


#: Entities of a batch that are looked up by name in the stored panel; more are joined without.
NAMED_ENTITIES = 1000


@dataclass(frozen=True)
class ServingPanel:
    """What requests are completed from, stored once: rows by (entity, period), trends by entity.

    Both tables are bucketed by their keys and sorted within buckets, so a join
    shuffles the requests only; a batch of few entities reads only the row groups
    that can hold them.
    """

    history: DataFrame
    trends: DataFrame


def store_serving_panel(panel: DataFrame, contract: Contract, name: str, path: str, entity_cols: list[str] = ["entity"],
                        period: str = "period", buckets: int | None = None) -> ServingPanel:
    """Write the serving tables ``<name>_history`` and ``<name>_trends`` below ``path`` and open them.

    ``buckets`` None: as many as the session has shuffle partitions.
    """
    spark = panel.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    on = [*entity_cols, period]
    fields = list(dict.fromkeys(f.column for f in contract.features))
    tables = {"history": (panel.select(*[col(c) for c in [*on, *fields]]), on),
              "trends": (request_trends(panel, contract, entity_cols, period), entity_cols)}
    for kind, (rows, keys) in tables.items():
        # dealt as the buckets are, so a task writes whole buckets and not a file of each
        (rows.repartition(n, *[col(k) for k in keys]).write.bucketBy(n, *keys).sortBy(*keys)
         .mode("overwrite").option("path", f"{path}/{kind}").format("parquet").saveAsTable(f"{name}_{kind}"))
    return open_serving_panel(spark, name)


def open_serving_panel(spark, name: str) -> ServingPanel:
    return ServingPanel(spark.table(f"{name}_history"), spark.table(f"{name}_trends"))


def of_batch(stored: ServingPanel, batch: DataFrame, entity_cols: list[str] = ["entity"]) -> ServingPanel:
    """The serving tables, filtered to the batch's entities where these are few.

    At most NAMED_ENTITIES + 1 names come to the driver; the filter reaches the scan.
    """
    if len(entity_cols) != 1:
        return stored
    key = entity_cols[0]
    names = [r[0] for r in batch.select(col(key)).where(col(key).isNotNull()).distinct().limit(NAMED_ENTITIES + 1).collect()]
    if len(names) > NAMED_ENTITIES:
        return stored
    return ServingPanel(stored.history.where(col(key).isin(names)), stored.trends.where(col(key).isin(names)))


def historical_defaults(keys: DataFrame, panel: DataFrame, contract: Contract,
                        entity_cols: list[str] = ["entity"], period: str = "period",
                        trends: DataFrame | None = None) -> DataFrame:
    """Feature values of each distinct (entity, period) in ``keys``.

    ``trends`` is a stored trend table; without one it is worked out for the
    entities of ``keys``.

    A known period gives its own values; any other period - later, earlier or
    in a gap - the anchored linear trend.  What is still missing gets the
    contract's constant.
    """
    fields = contract.features
    on = [*entity_cols, period]
    history = panel.select(
        *[col(k) for k in on],
        *[col(f.column).cast("double").alias(f"__h{i}") for i, f in enumerate(fields)],
        F.lit(True).alias("__known"),
    )
    if trends is None:
        trends = request_trends(panel, contract, entity_cols, period, keys)
    joined = keys.select(*[col(k) for k in on]).distinct().join(history, on, "left").join(
        trends, entity_cols, "left")
    linear = F.lit("linear")

    def value(i: int, default: float) -> Column:
        trend = trend_value(i, col(period), linear, "anchored")
        return F.coalesce(F.when(F.col("__known"), F.col(f"__h{i}")).otherwise(trend),
                          F.lit(float(default)))

    return joined.select(*[col(k) for k in on],
                         *[value(i, f.default).alias(f"__d{i}") for i, f in enumerate(fields)])


def resolve_features(requests: DataFrame, panel: DataFrame, contract: Contract,
                     entity_cols: list[str] = ["entity"], period: str = "period",
                     trends: DataFrame | None = None) -> DataFrame:
    """Explicit value, else default: every feature of every request is filled.

    Defaults are worked out once per distinct (entity, period) and joined back.
    The left join's own side is the large one; adaptive execution splits its
    partitions when a period is popular.
    """
    on = [*entity_cols, period]
    defaults = historical_defaults(requests, panel, contract, entity_cols, period, trends)
    return fill_from_defaults(requests.join(defaults, on, "left"), contract)


def fill_from_defaults(joined: DataFrame, contract: Contract) -> DataFrame:
    out = joined
    for i, f in enumerate(contract.features):
        given = col(f.name).cast("double") if f.name in joined.columns else F.lit(None).cast("double")
        out = out.withColumn(f.name, F.coalesce(given, F.col(f"__d{i}"), F.lit(float(f.default))))
        out = out.drop(f"__d{i}")
    return out


def predict_resolved(resolved: DataFrame, models: dict[str, PipelineModel], contract: Contract,
                     default_model: str, period: str = "period") -> DataFrame:
    """Prediction, rounded prediction, model used and echoed inputs of resolved requests."""
    named = col("model_name") if "model_name" in resolved.columns else F.lit(None).cast("string")
    ready = resolved.withColumn("model_used", F.coalesce(named, F.lit(default_model)))
    ready = ready.withColumn(contract.period_feature, col(period).cast("int"))
    for f in contract.features:
        if f.column != f.name:
            ready = ready.withColumn(f.column, col(f.name))
    echo = [contract.period_feature, *[f.name for f in contract.features]]
    dropped = {contract.period_feature, *[f.column for f in contract.features if f.column != f.name]}
    kept = [c for c in resolved.columns if c not in dropped and c != "model_name"]
    wide = score_by_own_model(ready, models, contract.model_features, "model_used")
    chosen = F.col(PREDICTED)
    return wide.select(
        *[col(c) for c in kept], "model_used", chosen.alias("prediction"),
        F.round(chosen, 2).alias("prediction_rounded"),
        F.map_from_arrays(F.array(*[F.lit(n) for n in echo]),
                          F.array(*[col(n).cast("double") for n in echo])).alias("input_features"),
        F.when(chosen.isNotNull(), "ok").otherwise("failed").alias("status"),
        F.when(chosen.isNotNull(), F.lit(CONFIDENCE_NOTE)).alias("confidence_note"),
    )


PREDICTED = "__predicted"


def score_by_own_model(rows: DataFrame, models: dict[str, PipelineModel], features: list[str], name: str) -> DataFrame:
    """``rows`` with PREDICTED by the model that the column ``name`` names, NULL where there is none of that name.

    Rows are stored once, in a folder per model; each model reads its own folder, so
    no row passes through a model it did not ask for.
    """
    spark = rows.sparkSession
    key = "__model_key"
    path = scratch_path(spark, "by-model")
    known = F.when(col(name).isin(list(models)), col(name)).otherwise(F.lit(""))
    stored = rows.withColumn(key, F.md5(known))
    stored.write.partitionBy(key).parquet(path)
    stored = spark.read.schema(stored.schema).parquet(path)
    parts = [stored.where(F.col(key) == hashlib.md5(b"").hexdigest()).withColumn(PREDICTED, F.lit(None).cast("double"))]
    for model_name, model in models.items():
        own = stored.where(F.col(key) == hashlib.md5(model_name.encode()).hexdigest())
        wide, made = score_wide(own, {model_name: model}, features)
        parts.append(wide.withColumnRenamed(made[model_name], PREDICTED))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.drop(key)


def score_requests(requests: DataFrame, panel: DataFrame, models: dict[str, PipelineModel],
                   contract: Contract, default_model: str, entity_cols: list[str] = ["entity"],
                   period: str = "period",
                   trends: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Scored valid requests, and the rejected ones with error codes."""
    good, rejected = split_valid(validate_requests(requests, contract, list(models), period=period))
    resolved = resolve_features(good, panel, contract, entity_cols, period, trends)
    return predict_resolved(resolved, models, contract, default_model, period), rejected


TOTALS_SCHEMA = "total_predictions long, successful long, failed long"


def batch_totals(scored: DataFrame, rejected: DataFrame | None = None) -> DataFrame:
    """Requests in total, successful and failed (rejected ones count as failed)."""
    flags = scored.select((F.col("status") == "ok").alias("ok"))
    if rejected is not None:
        flags = flags.unionByName(rejected.select(F.lit(False).alias("ok")))
    return flags.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.count_if("ok").alias("successful"),
        F.count_if(~F.col("ok")).alias("failed"),
    )


def write_scored(scored: DataFrame, rejected: DataFrame, scored_path: str, rejected_path: str,
                 mode: str = "error") -> DataFrame:
    """Write answers and rejected requests; the totals (TOTALS_SCHEMA) are counted while they are written.

    The numbers come from observations of the two writes, so nothing is scored or
    read a second time.
    """
    answers, refused = Observation(), Observation()
    (scored.observe(answers, F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "ok").alias("ok"))
     .write.mode(mode).parquet(scored_path))
    rejected.observe(refused, F.count(F.lit(1)).alias("n")).write.mode(mode).parquet(rejected_path)
    n, ok, bad = answers.get["n"], answers.get["ok"], refused.get["n"]
    return scored.sparkSession.createDataFrame([(n + bad, ok, n - ok + bad)], TOTALS_SCHEMA)


def year_range_requests(ranges: DataFrame, contract: Contract, start: str = "start_period",
                        end: str = "end_period",
                        period: str = "period") -> tuple[DataFrame, DataFrame]:
    """One request per period of each valid range; invalid ranges come back with codes."""
    rules = {
        "range_missing": col(start).isNull() | col(end).isNull(),
        "start_range": ~col(start).between(contract.period_low, contract.period_high),
        "end_range": ~col(end).between(contract.period_low, contract.period_high),
        "range_order": col(start) > col(end),
        "range_span": (col(end) - col(start)) > contract.max_span,
    }
    checked = ranges.withColumn("violations", F.array_compact(F.array(*[
        F.when(test, F.lit(code)) for code, test in rules.items()
    ])))
    good, bad = split_valid(checked)
    # Guard the sequence bounds: the filter above may run after the explode is planned.
    upper = F.least(col(end), col(start) + contract.max_span)
    return good.withColumn(period, F.explode(F.sequence(col(start), F.greatest(col(start), upper)))
                           ), bad


def interpret(prediction: Column, period: Column, entity: Column,
              bands: list[tuple] = STRESS_BANDS, text: str = INTERPRETATION) -> Column:
    """Band and wording of a prediction."""
    level, outlook = F.lit(bands[-1][1]), F.lit(bands[-1][2])
    for bound, name, view in reversed(bands[:-1]):
        level = F.when(prediction < bound, name).otherwise(level)
        outlook = F.when(prediction < bound, view).otherwise(outlook)
    return F.when(prediction.isNotNull(),
                  F.format_string(text, period.cast("int"), entity, level, prediction, outlook))


def score_scenario_requests(requests: DataFrame, panel: DataFrame, models: dict[str, PipelineModel],
                            contract: Contract, default_model: str,
                            entity_cols: list[str] = ["entity"], period: str = "period",
                            entity_name: str | None = None,
                            trends: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Extrapolate by the requested method (anchored rule), score, explain in words.

    A feature comes from the request, else from the trend under its method, else
    from the contract's constant; one trend table and one join give all of them.
    Scenario values are extrapolated whether or not the panel knows the period.
    """
    good, rejected = split_valid(
        validate_requests(requests, contract, list(models), scenario=True, period=period))
    if trends is None:
        trends = request_trends(panel, contract, entity_cols, period, good)
    resolved = good.join(trends, entity_cols, "left")
    for i, f in enumerate(contract.features):
        given = col(f.name).cast("double") if f.name in good.columns else F.lit(None).cast("double")
        resolved = resolved.withColumn(f.name, F.coalesce(
            given, trend_value(i, col(period), col("method"), "anchored"), F.lit(float(f.default))))
    resolved = resolved.select(*[col(c) for c in dict.fromkeys([*good.columns, *[f.name for f in contract.features]])])
    scored = predict_resolved(resolved, models, contract, default_model, period)
    who = F.lit(entity_name) if entity_name else col(entity_cols[0]).cast("string")
    return scored.withColumn("interpretation", interpret(F.col("prediction"), col(period), who)), rejected
