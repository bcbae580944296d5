"""Registered queries: request validation and scoring, manifests, run log, stream."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.operators import contract as CT
from panelwright.operators import scoring as G
from panelwright.plans import canonical as P
from panelwright.plans import sql as S
from panelwright.plans.catalog_models import linear_models, steady, steady_sql
from panelwright.plans.registry import query
from panelwright.session import scratch_path
from panelwright.sources import manifest as MF
from panelwright.sources import runlog as RL
from panelwright.streaming import request_scoring as RS

CONTRACT = CT.Contract(
    features=(CT.RequestFeature("clicks", "click", 8.0, 0.0, 300.0),
              CT.RequestFeature("errors", "error", 75.0, 0.0, 400.0)),
    target="view", period_low=0, period_high=100, scenario_low=30,
    shares=("clicks", "errors"), share_limit=250.0, max_span=10, scenario_period=60,
)
MODELS = ["LinearRegression", "Ridge"]
DEFAULT = "LinearRegression"


def requests(spark, sf_dir) -> DataFrame:
    """One request per event: some explicit values, odd model names, past and future days."""
    day = F.datediff(F.to_date("ts"), F.lit(P.EVENT_DAY_ZERO).cast("date"))
    kind, value = F.col("event_type"), F.col("value")
    return P.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_id"), F.col("user_id").alias("entity"),
        F.when(kind == "error", day + 80).when(kind == "signup", day + 10).otherwise(day).alias("period"),
        F.when(kind == "click", value).when(kind == "view", value / 2).alias("clicks"),
        F.when(kind == "error", value).when(kind == "view", value / 2 + 50).alias("errors"),
        F.when(kind == "purchase", F.lit("\t Ridge\n")).when(kind == "signup", F.lit(" \t"))
        .when((kind == "click") & (value < 10), F.lit("Unknown"))
        .when((kind == "click") & (value > 250), F.repeat(F.lit("m"), F.lit(60))).alias("model_name"),
    )


REQUESTS = """rq AS (
  SELECT event_id AS request_id, user_id AS entity,
    CAST(CASE event_type WHEN 'error' THEN d + 80 WHEN 'signup' THEN d + 10 ELSE d END AS INTEGER) AS period,
    CASE event_type WHEN 'click' THEN value WHEN 'view' THEN value / 2 END AS clicks,
    CASE event_type WHEN 'error' THEN value WHEN 'view' THEN value / 2 + 50 END AS errors,
    CASE WHEN event_type = 'purchase' THEN chr(9) || ' Ridge' || chr(10)
         WHEN event_type = 'signup' THEN ' ' || chr(9)
         WHEN event_type = 'click' AND value < 10 THEN 'Unknown'
         WHEN event_type = 'click' AND value > 250 THEN repeat('m', 60) END AS model_name
  FROM (SELECT *, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS d FROM events)),
ck AS (
  SELECT * EXCLUDE (model_name, named), CASE WHEN named <> '' THEN named END AS model_name,
    CASE WHEN period < 0 OR period > 100 THEN 'period_range,' ELSE '' END ||
    CASE WHEN clicks < 0 OR clicks > 300 THEN 'clicks_range,' ELSE '' END ||
    CASE WHEN errors < 0 OR errors > 400 THEN 'errors_range,' ELSE '' END ||
    CASE WHEN clicks + errors > 250 THEN 'share_sum,' ELSE '' END ||
    CASE WHEN length(model_name) > 50 THEN 'model_name_length,' ELSE '' END ||
    CASE WHEN named NOT IN ('', 'LinearRegression', 'Ridge') THEN 'model_unknown,' ELSE '' END AS codes
  FROM (SELECT *, regexp_replace(model_name, '^\\s+|\\s+$', '', 'g') AS named FROM rq))"""

TRENDS = S.trend_state().split(S.PANEL + ", ")[1]

# Defaults: the panel row of the day, else the anchored linear trend, else the constant.
RESOLVED = f"""ok AS (SELECT * FROM ck WHERE codes = ''),
tl AS (SELECT entity, indicator, CASE WHEN n >= 2 THEN last END AS last, (last - oldest) / span AS slope, last_seen
       FROM trend),
rs AS (
  SELECT ok.request_id, ok.entity, ok.period, ok.model_name,
    coalesce(ok.clicks, CASE WHEN panel.entity IS NOT NULL THEN panel.click
             ELSE c.last + c.slope * (ok.period - c.last_seen) END, 8.0) AS clicks,
    coalesce(ok.errors, CASE WHEN panel.entity IS NOT NULL THEN panel.error
             ELSE e.last + e.slope * (ok.period - e.last_seen) END, 75.0) AS errors
  FROM ok LEFT JOIN panel ON ok.entity = panel.entity AND ok.period = panel.period
  LEFT JOIN (SELECT * FROM tl WHERE indicator = 'click') c ON ok.entity = c.entity
  LEFT JOIN (SELECT * FROM tl WHERE indicator = 'error') e ON ok.entity = e.entity)"""

SCORED = f"""sd AS (
  SELECT rs.*, w.model AS model_used,
    my + w1 * (period - m1) / s1 + w2 * (clicks - m2) / s2 + w3 * (errors - m3) / s3 AS prediction
  FROM rs JOIN w ON w.model = coalesce(rs.model_name, 'LinearRegression'), st)"""

ALL = f"{S.MODELS}, {TRENDS}, {REQUESTS}, {RESOLVED}, {SCORED}"


@query("G9", S.with_(REQUESTS, "SELECT request_id, model_name, rtrim(codes, ',') AS codes FROM ck"))
def validate_requests(spark, sf_dir) -> DataFrame:
    """Every broken rule of every request, and the tidied model name."""
    checked = CT.validate_requests(requests(spark, sf_dir), CONTRACT, MODELS)
    return checked.select("request_id", "model_name", F.concat_ws(",", "violations").alias("codes"))


@query("G5", S.with_(f"{S.PANEL}, {TRENDS}, {REQUESTS}, {RESOLVED}",
                     "SELECT request_id, entity, period, clicks, errors FROM rs", ["clicks", "errors"]))
def request_defaults(spark, sf_dir) -> DataFrame:
    """Explicit value, else history of the day, else linear trend, else constant."""
    good, _ = CT.split_valid(CT.validate_requests(requests(spark, sf_dir), CONTRACT, MODELS))
    resolved = G.resolve_features(good, P.events_panel_stored(spark, sf_dir), CONTRACT)
    return resolved.select("request_id", "entity", "period", "clicks", "errors")


def scored_requests(spark, sf_dir):
    models = linear_models(spark, sf_dir).models
    return G.score_requests(requests(spark, sf_dir), P.events_panel_stored(spark, sf_dir), models, CONTRACT, DEFAULT)


SCORED_BODY = """SELECT request_id, entity, period, model_used, prediction,
    'year=' || period AS echoed_year, clicks AS echoed_clicks, 'ok' AS status FROM sd
  UNION ALL SELECT request_id, entity, period, NULL, NULL, NULL, NULL, 'rejected: ' || rtrim(codes, ',') FROM ck WHERE codes <> ''"""


def scored_view(scored: DataFrame, rejected: DataFrame) -> DataFrame:
    """Answers, and the rejected requests with their codes."""
    answers = scored.select(
        "request_id", "entity", "period", "model_used", "prediction",
        F.concat(F.lit("year="), F.col("input_features")["year"].cast("int")).alias("echoed_year"),
        F.col("input_features")["clicks"].alias("echoed_clicks"), "status")
    refused = rejected.select("request_id", "entity", "period", F.concat(
        F.lit("rejected: "), F.concat_ws(",", "violations")).alias("status"))
    return answers.unionByName(refused, allowMissingColumns=True)


@query("G6", S.with_(ALL, SCORED_BODY, ["prediction", "echoed_clicks"]))
def score_requests(spark, sf_dir) -> DataFrame:
    """Requests as a table: validated, completed, scored by the model they name."""
    return scored_view(*scored_requests(spark, sf_dir))


@query("G6", S.with_(REQUESTS, """SELECT count(*) AS total_predictions,
    count(*) FILTER (WHERE codes = '') AS successful, count(*) FILTER (WHERE codes <> '') AS failed FROM ck"""))
def batch_totals(spark, sf_dir) -> DataFrame:
    """Totals counted while the answers are written."""
    path = scratch_path(spark, "answers")
    return G.write_scored(*scored_requests(spark, sf_dir), f"{path}/scored", f"{path}/rejected")


@query("G7", f"""WITH r AS (SELECT o_orderkey, CAST(o_custkey % 90 AS INTEGER) AS a,
      CAST(o_custkey % 90 + o_orderkey % 14 - 1 AS INTEGER) AS b FROM orders),
    g AS (SELECT * FROM r WHERE a <= b AND b - a <= 10)
    SELECT o_orderkey AS request_id, CAST(unnest(range(a, b + 1)) AS INTEGER) AS period, '' AS codes FROM g WHERE b BETWEEN 0 AND 100
    UNION ALL SELECT o_orderkey, NULL, rtrim(CASE WHEN b NOT BETWEEN 0 AND 100 THEN 'end_range,' ELSE '' END ||
      CASE WHEN a > b THEN 'range_order,' ELSE '' END || CASE WHEN b - a > 10 THEN 'range_span,' ELSE '' END, ',')
    FROM r WHERE b NOT BETWEEN 0 AND 100 OR a > b OR b - a > 10""")
def year_range(spark, sf_dir) -> DataFrame:
    """One request per year of each valid range; too long or reversed ranges come back with their codes."""
    ranges = P.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("request_id"), (F.col("o_custkey") % 90).cast("int").alias("start_period"),
        (F.col("o_custkey") % 90 + F.col("o_orderkey") % 14 - 1).cast("int").alias("end_period"))
    good, bad = G.year_range_requests(ranges, CONTRACT)
    refused = bad.select("request_id", F.lit(None).cast("int").alias("period"), F.concat_ws(",", "violations").alias("codes"))
    return good.select("request_id", "period", F.lit("").alias("codes")).unionByName(refused)


SCENARIO_REQUESTS = """sq AS (
  SELECT event_id AS request_id, user_id AS entity,
    CAST(CASE WHEN event_type = 'signup' AND event_id % 2 = 0 THEN 60 ELSE 30 + d END AS INTEGER) AS period,
    CASE WHEN event_type = 'error' THEN 'average' WHEN event_type = 'view' THEN 'last_value'
      WHEN event_type = 'purchase' AND value < 20 THEN 'cubic' WHEN event_type = 'purchase' THEN 'exponential'
      ELSE 'linear' END AS method,
    CASE WHEN event_type = 'signup' THEN 'Ridge' ELSE 'LinearRegression' END AS model_used
  FROM (SELECT *, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS d FROM events))"""


def anchored_pick(indicator: str, fallback: str) -> str:
    """The anchored value over the columns of the indicator's own trend alias, else the constant."""
    value = re.sub(r"\b(n|last|oldest|span|last_seen|mean)\b", rf"{indicator[0]}.\1", S.ANCHORED_VALUE)
    return f"coalesce({value}, {fallback})"


BANDS = """CASE WHEN prediction < 25 THEN 'low' WHEN prediction < 50 THEN 'low-medium'
       WHEN prediction < 75 THEN 'medium-high' WHEN prediction < 100 THEN 'high' ELSE 'critical' END"""
OUTLOOKS = f"CASE {BANDS} " + " ".join(f"WHEN '{name}' THEN '{view}'" for _, name, view in G.STRESS_BANDS) + " END"
NOTE = G.INTERPRETATION.split("%s. ")[-1]


@query("G8", S.with_(f"{S.MODELS}, {TRENDS}, {SCENARIO_REQUESTS}" + f""", sx AS (
    SELECT request_id, sq.entity, period, method, model_used,
      {anchored_pick('click', '8.0')} AS clicks, {anchored_pick('error', '75.0')} AS errors
    FROM sq LEFT JOIN (SELECT * FROM trend WHERE indicator = 'click') c ON sq.entity = c.entity
            LEFT JOIN (SELECT * FROM trend WHERE indicator = 'error') e ON sq.entity = e.entity
    WHERE method <> 'cubic'),
  sp AS (SELECT sx.*, my + w1 * (period - m1) / s1 + w2 * (clicks - m2) / s2 + w3 * (errors - m3) / s3 AS prediction
         FROM sx JOIN w ON w.model = model_used, st)""",
  steady_sql(f"""SELECT request_id, entity, period, method, model_used, prediction,
     'By ' || period || ', ' || entity || ' is predicted to have ' || {BANDS} || ' water stress at ' ||
     CASE WHEN abs(prediction) >= 1e6 THEN '' ELSE printf('%.1f', prediction) END || '%. This indicates ' || {OUTLOOKS} || '. {NOTE}'
     AS interpretation FROM sp
     UNION ALL SELECT request_id, entity, period, method, NULL, NULL, 'rejected: method_unknown' FROM sq WHERE method = 'cubic'""",
     "prediction"), ["prediction"]))
def scenario_requests(spark, sf_dir) -> DataFrame:
    """Extrapolate by the asked method, score, explain in words; some name no method or no period.

    Numbers of a million and more are compared to seven digits, and left out of the text.
    """
    day = F.datediff(F.to_date("ts"), F.lit(P.EVENT_DAY_ZERO).cast("date"))
    kind = F.col("event_type")
    asked = P.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_id"), F.col("user_id").alias("entity"),
        F.when((kind != "signup") | (F.col("event_id") % 2 == 1), day + 30).alias("period"),
        F.when(kind == "error", "average").when(kind == "view", "last_value").when(kind == "click", "linear")
        .when((kind == "purchase") & (F.col("value") < 20), "cubic").when(kind == "purchase", "exponential").alias("method"),
        F.when(kind == "signup", "Ridge").alias("model_name"))
    scored, rejected = G.score_scenario_requests(asked, P.events_panel_stored(spark, sf_dir),
                                                 linear_models(spark, sf_dir).models, CONTRACT, DEFAULT)
    text = F.when(F.abs("prediction") >= 1e6, F.regexp_replace("interpretation", r"at -?[0-9.]+%", "at %")).otherwise(
        F.col("interpretation"))
    answers = scored.select("request_id", "entity", "period", "method", "model_used", "prediction", text.alias("interpretation"))
    refused = rejected.select("request_id", "entity", "period", "method", F.concat(
        F.lit("rejected: "), F.concat_ws(",", "violations")).alias("interpretation"))
    return steady(answers.unionByName(refused, allowMissingColumns=True), "prediction")


def streamed(spark, sf_dir) -> str:
    """Folder of the answers to all requests, which arrived as files."""
    inbox, out = scratch_path(spark, "requests"), scratch_path(spark, "scored")
    asked = requests(spark, sf_dir)
    asked.repartition(6).write.parquet(inbox)
    run = RS.start_scoring(RS.request_stream(spark, inbox, asked.schema, files_per_batch=4),
                           P.events_panel(spark, sf_dir), linear_models(spark, sf_dir).models,
                           CONTRACT, DEFAULT, out, scratch_path(spark, "stream-checkpoint"))
    run.awaitTermination()
    return out


@query("S1", S.with_(ALL, SCORED_BODY, ["prediction", "echoed_clicks"]))
def stream_scoring(spark, sf_dir) -> DataFrame:
    """The same requests arriving as files, scored by a stream until none is left."""
    out = streamed(spark, sf_dir)
    return scored_view(RS.read_scored(spark, out), RS.read_rejected(spark, out))


@query("S1 G6", S.with_(REQUESTS, """SELECT count(*) AS total_predictions,
    count(*) FILTER (WHERE codes = '') AS successful, count(*) FILTER (WHERE codes <> '') AS failed FROM ck"""))
def stream_totals(spark, sf_dir) -> DataFrame:
    """What the micro-batches counted while they wrote, added up."""
    return RS.read_totals(spark, streamed(spark, sf_dir))


# --- manifests and run log ----------------------------------------------------------


def document_manifest(spark, sf_dir, changed: bool) -> DataFrame:
    docs = P.table(spark, sf_dir, "documents")
    text = F.col("text")
    if changed:
        docs = docs.filter("lang <> 'de'")
        text = F.when(F.col("lang") == "fr", F.concat(text, F.lit("!"))).otherwise(text)
    return docs.select(F.concat(F.lit("doc/"), F.col("doc_id")).alias("path"), F.sha2(text, 256).alias("hash"))


@query("H2", """SELECT 'doc/' || doc_id AS path, sha256(text) AS hash,
    CASE lang WHEN 'de' THEN NULL WHEN 'fr' THEN sha256(text || '!') ELSE sha256(text) END AS current_hash,
    CASE lang WHEN 'de' THEN 'missing' WHEN 'fr' THEN 'changed' ELSE 'ok' END AS status,
    lang NOT IN ('de', 'fr') AS is_valid FROM documents""")
def verify_manifest(spark, sf_dir) -> DataFrame:
    """Stored hashes of the documents against a later state with edits and removals."""
    return MF.verify_manifest(document_manifest(spark, sf_dir, False), document_manifest(spark, sf_dir, True))


@query("H1", """SELECT n_nationkey AS key, sha256(n_name || chr(10)) AS hash, strlen(n_name) + 1 AS size_bytes,
    'tables' AS source FROM nation""")
def file_manifest(spark, sf_dir) -> DataFrame:
    """Hash and size of one small text file per nation; a path that does not exist is skipped."""
    path = scratch_path(spark, "nations")
    P.table(spark, sf_dir, "nation").select("n_nationkey", "n_name").write.partitionBy("n_nationkey").text(path)
    built = MF.build_manifest(spark, [path, path + "/absent"], source="tables").filter("size_bytes > 0")
    key = F.regexp_extract("path", "n_nationkey=([0-9]+)/", 1).cast("int")
    return built.filter("path like '%/part-%'").select(key.alias("key"), "hash", "size_bytes", "source")


@query("H3", """SELECT 'doc/' || doc_id AS path, sha256(text) AS hash FROM documents WHERE lang = 'en'""")
def manifest_roundtrip(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "manifest")
    full = document_manifest(spark, sf_dir, False).join(
        P.table(spark, sf_dir, "documents").select(
            F.concat(F.lit("doc/"), F.col("doc_id")).alias("path"), F.col("n_chars").alias("size_bytes"),
            F.lit(None).cast("timestamp").alias("last_modified"), F.col("lang").alias("source"),
            F.lit(None).cast("string").alias("description")), "path")
    MF.save_manifest(full, path)
    return MF.load_manifest(spark, path).filter("source = 'en'").select("path", "hash")


def order_runs(spark, sf_dir) -> DataFrame:
    """Orders as a run log: priority = experiment, customer = run, price = metric by step."""
    return P.table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("experiment"), F.col("o_custkey").cast("string").alias("run_id"),
        F.col("o_custkey").alias("started"), F.lit("metric").alias("kind"),
        F.when(F.col("o_orderstatus") == "F", "test_r2").otherwise("train_r2").alias("key"),
        F.lit(None).cast("string").alias("value_str"), F.col("o_totalprice").alias("value_dbl"),
        F.col("o_orderkey").cast("int").alias("step"))


@query("H4", """SELECT o_custkey::VARCHAR AS run_id, CASE WHEN o_orderstatus = 'F' THEN 'test_r2' ELSE 'train_r2' END AS key,
    o_totalprice AS value_dbl FROM orders WHERE o_orderpriority = '2-HIGH'""")
def run_log_roundtrip(spark, sf_dir) -> DataFrame:
    """Append to the log, read one experiment back."""
    path = scratch_path(spark, "runs")
    RL.append_runs(order_runs(spark, sf_dir), path)
    return RL.read_runs(spark, path, "2-HIGH").select("run_id", "key", "value_dbl")


@query("H5", """WITH per AS (SELECT o_orderpriority AS experiment, o_custkey, arg_max(o_totalprice, o_orderkey) AS value
      FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2)
    SELECT experiment, o_custkey::VARCHAR AS run_id, value FROM per
    QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY value DESC, o_custkey) = 1""")
def best_run(spark, sf_dir) -> DataFrame:
    """Run with the best last value of a metric; runs without it drop out."""
    return RL.best_run(order_runs(spark, sf_dir), "test_r2")
