"""Registered queries: sources, filters, reshaping, order-dependent operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.operators import columns as C
from panelwright.operators import ordered as O
from panelwright.operators import reshape as R
from panelwright.plans import canonical as P
from panelwright.plans import sql as S
from panelwright.plans.registry import query
from panelwright.session import scratch_path
from panelwright.sources import longtable as L
from panelwright.sources import panels as PN

TYPES = P.EVENT_TYPES
TYPES_SQL = ", ".join(TYPES)


def raw_csv(spark: SparkSession, sf_dir: str) -> str:
    """The events as a long CSV with odd names, bad numbers and comment lines, in event order."""
    events = P.table(spark, sf_dir, "events")
    user = F.concat(F.lit(" User "), F.col("user_id").cast("string"), F.lit(" "))
    day = F.datediff(F.to_date("ts"), F.lit(P.EVENT_DAY_ZERO).cast("date"))
    data = events.select(
        "event_id", F.lit(1).alias("line"), user.alias("Country Name"),
        F.col("user_id").cast("string").alias("Country Code"),
        F.col("event_type").alias("Indicator Name"), F.upper("event_type").alias("Indicator Code"),
        F.when(F.col("event_type") == "error", F.concat(day.cast("string"), F.lit(".0")))
        .when(F.col("event_type") == "signup", F.lit("n/a")).otherwise(day.cast("string")).alias("Year"),
        F.when(F.col("value") < 5, F.lit("..")).otherwise(F.col("value").cast("string")).alias("Value"),
    )
    note = events.select(
        "event_id", F.lit(0).alias("line"), F.concat(F.lit("# row "), F.col("event_id")).alias("Country Name"),
        *[F.lit(None).cast("string").alias(c) for c in L.RAW_HEADER[1:]],
    )
    path = scratch_path(spark, "long-csv")
    (data.unionByName(note).repartitionByRange("event_id").sortWithinPartitions("event_id", "line")
     .select(*L.RAW_HEADER).write.option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


RAW = """raw AS (
  SELECT event_id, user_id, event_type AS indicator,
         CASE WHEN event_type = 'signup' THEN NULL
              ELSE CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) END AS period,
         CASE WHEN value < 5 THEN NULL ELSE value END AS value FROM events),
kept AS (SELECT * FROM raw WHERE period IS NOT NULL)"""


@query("A1 B3", S.with_(RAW, """
  SELECT 'user ' || user_id AS entity_key, upper(indicator) AS indicator_code, period, value FROM kept""",
                       ["value"]))
def read_long_csv(spark, sf_dir) -> DataFrame:
    """Long CSV: comments skipped, bad periods dropped, bad values null."""
    long = L.canonical_long(L.read_long(spark, raw_csv(spark, sf_dir)))
    return long.select("entity_key", "indicator_code", "period", "value")


@query("A1 C1", S.with_(RAW, """
  SELECT 'user ' || user_id AS entity, period,
         arg_min(value, event_id) FILTER (WHERE indicator = 'click') AS click,
         arg_min(value, event_id) FILTER (WHERE indicator = 'error') AS error
  FROM kept WHERE value IS NOT NULL AND indicator IN ('click', 'error') GROUP BY 1, 2""",
                       ["click", "error"]))
def pivot_first_in_file_order(spark, sf_dir) -> DataFrame:
    """First non-null value by position in the files, not by any data column."""
    long = L.canonical_long(L.read_long(spark, raw_csv(spark, sf_dir)))
    return R.pivot_first(long.withColumn("entity", F.col("entity_key")), indicators=["click", "error"])


def quoted_csv(spark: SparkSession, sf_dir: str) -> str:
    """The events as a long CSV whose indicator names have a line end and quotes inside."""
    path = scratch_path(spark, "quoted-csv")
    events = P.events_long(spark, sf_dir)
    (events.repartitionByRange("ordinal").sortWithinPartitions("ordinal").select(
        F.concat(F.lit("User "), F.col("entity")).alias("Country Name"), F.lit("C").alias("Country Code"),
        F.concat(F.lit('the "'), F.col("indicator"), F.lit('",\nper day')).alias("Indicator Name"), F.upper("indicator").alias("Indicator Code"),
        F.when(F.col("indicator") == "signup", "n/a").otherwise(F.col("period").cast("string")).alias("Year"),
        F.col("value").cast("string").alias("Value"))
     .write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path))
    return path


@query("A1 C1", S.with_(S.PANEL, """SELECT 'user ' || entity AS entity, period, click, error FROM panel
    WHERE click IS NOT NULL OR error IS NOT NULL""", ["click", "error"]))
def read_long_quoted(spark, sf_dir) -> DataFrame:
    """Cells with line ends and quotes inside: first values in file order."""
    long = L.canonical_long(L.read_long(spark, quoted_csv(spark, sf_dir), multiline=True))
    names = {f'the "{t}",\nper day': t for t in ("click", "error")}
    wide = R.pivot_first(long.withColumn("entity", F.col("entity_key")), indicators=list(names))
    return wide.select("entity", "period", *[F.col(f"`{n}`").alias(t) for n, t in names.items()])


@query("A1 B3", """SELECT event_type AS indicator, count(*) AS n_rows, 'no_period' AS reason FROM events
    WHERE event_type = 'signup' GROUP BY 1""")
def dropped_long_rows(spark, sf_dir) -> DataFrame:
    """What the canonical form leaves out, and why."""
    raw = L.read_long(spark, quoted_csv(spark, sf_dir), multiline=True)
    return L.dropped_rows(raw).groupBy(F.lower("Indicator Code").alias("indicator"), "reason").agg(F.count(F.lit(1)).alias("n_rows"))


@query("A3 C2", S.with_(S.EV, "SELECT period, " + ", ".join(f"avg(value) FILTER (WHERE indicator = '{t}') AS {t}" for t in TYPES)
                        + " FROM ev GROUP BY period", TYPES))
def first_readable_panel(spark, sf_dir) -> DataFrame:
    """The first candidate that can be read, a long CSV, told from a wide one by its names, to a wide panel of means."""
    folder = scratch_path(spark, "candidates")
    P.events_long(spark, sf_dir).select(
        F.concat(F.lit("User "), F.col("entity")).alias("Country Name"), F.col("indicator").alias("Indicator Name"),
        F.col("period").alias("Year"), F.col("value").alias("Value")).write.option("header", True).csv(f"{folder}/long.csv")
    found = L.read_any(spark, [f"{folder}/absent.parquet", f"{folder}/absent.csv", f"{folder}/long.csv"])
    return L.to_panel(found, "User", indicators=TYPES)


@query("A2 A4", S.with_(S.PANEL, f"SELECT entity, period, {TYPES_SQL} FROM panel", TYPES))
def panel_roundtrip(spark, sf_dir) -> DataFrame:
    """Wide panel written as Parquet and read back."""
    path = scratch_path(spark, "panel")
    PN.write_panel(P.events_panel(spark, sf_dir), path)
    return PN.read_panel(spark, path, period="period", entity_cols=["entity"])


CODES = """CASE entity WHEN 'A' THEN '007' WHEN 'N' THEN '01' ELSE entity END"""


@query("A2 A4", S.with_(S.LINES_PANEL, f"SELECT {CODES} AS entity, period, gross, tax FROM lines_panel", ["gross", "tax"]))
def panel_csv_roundtrip(spark, sf_dir) -> DataFrame:
    """Wide panel as CSV partitioned by entity; the schema comes from the header, codes stay as written."""
    path = scratch_path(spark, "panel-csv")
    panel = P.lines_panel(spark, sf_dir).select(F.expr(CODES).alias("entity"), "period", "gross", "tax")
    PN.write_panel(panel, path, fmt="csv", partition_by=["entity"])
    back = PN.read_panel(spark, path, fmt="csv", period="period", entity_cols=["entity"], entity_types={"entity": "string"})
    return back.select("entity", "period", "gross", "tax")


@query("A1 B3", S.with_(S.EV, """SELECT 'user ' || entity AS entity_key, upper(indicator) AS indicator_code, period, value
    FROM ev""", ["value"]))
def read_long_parquet(spark, sf_dir) -> DataFrame:
    """Long Parquet with its own types and a stored order; names are padded with tabs."""
    path = scratch_path(spark, "long-parquet")
    P.events_long(spark, sf_dir).select(
        F.concat(F.lit("\tUser "), F.col("entity"), F.lit(" \n")).alias("Country Name"), F.lit("C").alias("Country Code"),
        F.col("indicator").alias("Indicator Name"), F.upper("indicator").alias("Indicator Code"),
        F.col("period").alias("Year"), F.col("value").alias("Value"), "ordinal").write.parquet(path)
    long = L.canonical_long(L.read_long(spark, path, "parquet", ordinal="ordinal"))
    return long.select("entity_key", "indicator_code", "period", "value")


def long_file_shape(spark, sf_dir) -> DataFrame:
    return P.events_long(spark, sf_dir).select(
        F.when(F.col("indicator") != "error", F.concat(F.lit("user "), F.col("entity"))).alias("Country Name"),
        F.col("indicator").alias("Indicator Name"), F.col("period").cast("string").alias("Year"),
        F.col("value").cast("string").alias("Value"),
    )


@query("A3 B1 C2", S.with_(S.EV, """
  SELECT period, avg(value) FILTER (WHERE indicator = 'click') AS click,
         avg(value) FILTER (WHERE indicator = 'error') AS error,
         avg(value) FILTER (WHERE indicator = 'view') AS view
  FROM ev WHERE (indicator = 'error' OR 'user ' || entity LIKE '%user 1%')
    AND indicator IN ('click', 'error', 'view') GROUP BY period""", ["click", "error", "view"]))
def long_layout_to_panel(spark, sf_dir) -> DataFrame:
    """Long layout recognised by column names; name contains the text or is missing; mean pivot."""
    return L.to_panel(long_file_shape(spark, sf_dir), entity_text="user 1",
                      indicators=["click", "error", "view"])


@query("A3 B3", """SELECT CAST(o_orderkey AS INTEGER) AS period,
    round(o_totalprice, 6) + 0 AS total, CAST(NULL AS DOUBLE) AS priority FROM orders""")
def wide_layout_to_panel(spark, sf_dir) -> DataFrame:
    """Wide layout recognised by column names; text columns become missing numbers."""
    return L.to_panel(P.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("Year"), F.col("o_totalprice").alias("total"),
        F.col("o_orderpriority").alias("priority")))


@query("B1", """SELECT c_custkey, c_mktsegment FROM customer WHERE lower(trim(c_mktsegment)) = 'building'""")
def entity_equality(spark, sf_dir) -> DataFrame:
    return P.table(spark, sf_dir, "customer").filter(
        L.entity_is("  BuilDing ", "c_mktsegment")).select("c_custkey", "c_mktsegment")


@query("B2", """SELECT count(*) AS n_rows, count(DISTINCT indicator) AS n_types FROM
    (SELECT event_type AS indicator, CASE WHEN event_type = 'error' THEN '#country+name' END AS entity FROM events)
    WHERE entity IS NULL OR entity <> '#country+name'""")
def drop_metadata(spark, sf_dir) -> DataFrame:
    marked = P.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("indicator"),
        F.when(F.col("event_type") == "error", F.lit(L.METADATA_ENTITY)).alias("entity"))
    return L.drop_metadata_rows(marked).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("indicator").alias("n_types"))


@query("B4", """SELECT event_type AS indicator, count(*) AS n FROM events
    WHERE event_type IN ('click', 'view') GROUP BY 1""")
def indicator_set(spark, sf_dir) -> DataFrame:
    return L.indicators_in(P.events_long(spark, sf_dir), ["click", "view"]).groupBy("indicator").agg(
        F.count(F.lit(1)).alias("n"))


@query("B4", """SELECT source AS indicator, count(*) AS n FROM documents
    WHERE lower(source) LIKE '%rc1%' GROUP BY 1""")
def indicator_search(spark, sf_dir) -> DataFrame:
    docs = P.table(spark, sf_dir, "documents").select(F.col("source").alias("indicator"))
    return L.indicators_like(docs, "RC1").groupBy("indicator").agg(F.count(F.lit(1)).alias("n"))


@query("B5 B8", S.with_(S.LINES_PANEL, "SELECT entity, period, tax, gross, quantity FROM lines_panel",
                        ["tax", "gross", "quantity"]))
def explicit_features(spark, sf_dir) -> DataFrame:
    """Explicit list: unknown names dropped, target last and never a feature."""
    return C.modeling_frame(P.lines_panel(spark, sf_dir), "quantity",
                            features=["tax", "no such column", "gross", "quantity"])


@query("B6", """WITH names AS (SELECT DISTINCT l_shipinstr AS n FROM (
      SELECT event_type AS l_shipinstr FROM events UNION ALL SELECT source FROM documents)),
    tier AS (SELECT n, CASE WHEN contains(lower(n), 'zz') THEN 1
                            WHEN contains(lower(n), 'ur') OR contains(lower(n), 'si') THEN 2 END AS t FROM names)
    SELECT n AS target FROM tier WHERE t IS NOT NULL ORDER BY t, n LIMIT 1""")
def choose_target(spark, sf_dir) -> DataFrame:
    """First-choice words, then second-choice words, then name order."""
    names = P.table(spark, sf_dir, "events").select(F.col("event_type").alias("indicator")).unionByName(
        P.table(spark, sf_dir, "documents").select(F.col("source").alias("indicator")))
    return C.target_candidates(R.list_indicators(names), first=["zz"], second=["ur", "si"])


@query("B7", """WITH names AS (SELECT DISTINCT event_type AS n FROM events),
    hit AS (SELECT n, CASE WHEN contains(n, 'i') THEN 0 WHEN contains(n, 'r') THEN 1 END AS k
            FROM names WHERE NOT contains(n, 'gnu'))
    SELECT n AS feature, CAST(k AS INTEGER) AS keyword_pos FROM hit WHERE k IS NOT NULL ORDER BY k, n LIMIT 3""")
def keyword_columns(spark, sf_dir) -> DataFrame:
    """Keyword-major order, blacklist, no repeats, at most three."""
    return C.keyword_columns(R.list_indicators(P.events_long(spark, sf_dir)), ["I", "r"], 3, ["GNU"])


@query("B9", S.with_(S.LINES_PANEL, "SELECT gross, net, charged, quantity, discount, tax FROM lines_panel",
                     ["gross", "net", "charged", "quantity", "discount", "tax"]))
def numeric_columns_only(spark, sf_dir) -> DataFrame:
    return C.numeric_only(P.lines_panel(spark, sf_dir))


@query("B10", S.with_(S.PANEL, "SELECT entity, period, click, purchase, signup FROM panel",
                      ["click", "purchase", "signup"]))
def first_feature_columns(spark, sf_dir) -> DataFrame:
    panel = P.events_panel(spark, sf_dir)
    return C.select_features(panel, C.first_features(panel, target="error", k=3))


@query("B11", S.with_(S.ORDERS_PANEL, """SELECT entity, period, revenue FROM orders_panel
    WHERE period BETWEEN 10 AND 40""", ["revenue"]))
def period_range_filter(spark, sf_dir) -> DataFrame:
    return C.period_range(P.orders_panel(spark, sf_dir), 10, 40).select("entity", "period", "revenue")


@query("B12", S.with_(S.PANEL, "SELECT entity, period, click, period AS year FROM panel", ["click"]))
def year_feature(spark, sf_dir) -> DataFrame:
    return C.add_year_column(P.events_panel(spark, sf_dir)).select("entity", "period", "click", "year")


@query("B13", S.with_(S.PANEL + """, f AS (SELECT
      avg(CASE WHEN click IS NULL THEN 1.0 ELSE 0.0 END) AS click,
      avg(CASE WHEN error IS NULL THEN 1.0 ELSE 0.0 END) AS error,
      avg(CASE WHEN purchase IS NULL THEN 1.0 ELSE 0.0 END) AS purchase,
      avg(CASE WHEN signup IS NULL THEN 1.0 ELSE 0.0 END) AS signup,
      avg(CASE WHEN view IS NULL THEN 1.0 ELSE 0.0 END) AS view FROM panel)""",
    """SELECT c AS "column", v <= 0.598 AS kept
       FROM f UNPIVOT (v FOR c IN (click, error, purchase, signup, view))"""))
def sparse_columns(spark, sf_dir) -> DataFrame:
    """Which columns survive the sparse filter (several sit near the threshold)."""
    panel = P.events_panel(spark, sf_dir)
    left = R.drop_sparse_columns(panel, 0.598).columns
    return R.list_indicators(P.events_long(spark, sf_dir)).select(
        F.col("indicator").alias("column"), F.col("indicator").isin(left).alias("kept"))


@query("C1", S.with_(S.PANEL, f"SELECT entity, period, {TYPES_SQL} FROM panel", TYPES))
def pivot_first(spark, sf_dir) -> DataFrame:
    return P.events_panel(spark, sf_dir)


@query("C1 C4", S.with_(S.PANEL, f"SELECT entity, period, {TYPES_SQL} FROM panel", TYPES))
def pivot_discovered(spark, sf_dir) -> DataFrame:
    """Indicator names found in the data, columns sorted by name."""
    return R.pivot_first(P.events_long(spark, sf_dir))


@query("C2", S.with_(S.EV, f"""SELECT entity, period,
    {', '.join(f"avg(value) FILTER (WHERE indicator = '{c}') AS {c}" for c in TYPES)}
    FROM ev GROUP BY entity, period""", TYPES))
def pivot_mean(spark, sf_dir) -> DataFrame:
    return R.pivot_mean(P.events_long(spark, sf_dir), indicators=TYPES)


@query("C3", S.with_(S.LINES_PANEL, """SELECT entity, period, gross, tax FROM lines_panel""", ["gross", "tax"]))
def pivot_strict(spark, sf_dir) -> DataFrame:
    """Unique cells pivot; a repeated one would fail the query."""
    from panelwright.functions.numeric import melt
    long = melt(P.lines_panel(spark, sf_dir), ["entity", "period"], ["gross", "tax"])
    return R.pivot_strict(long, indicators=["gross", "tax"])


@query("C3", S.with_(S.EV, """SELECT entity, period, indicator, count(*) AS n_rows FROM ev
    GROUP BY 1, 2, 3 HAVING count(*) > 1"""))
def duplicate_cells(spark, sf_dir) -> DataFrame:
    return R.duplicate_cells(P.events_long(spark, sf_dir))


@query("C4", "SELECT DISTINCT event_type AS indicator FROM events")
def list_indicators(spark, sf_dir) -> DataFrame:
    return R.list_indicators(P.events_long(spark, sf_dir))


@query("C5", S.with_(S.PANEL, " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_count, "
    f"CAST(count(*) - count({c}) AS BIGINT) AS null_count FROM panel" for c in TYPES)))
def profile(spark, sf_dir) -> DataFrame:
    return R.profile(P.events_panel(spark, sf_dir), TYPES)


@query("D1", S.with_(S.FILLED + """, lagged AS (
    SELECT entity, period, click, view,
           lag(click, 1) OVER w AS click_lag1, lag(click, 2) OVER w AS click_lag2,
           lag(view, 1) OVER w AS view_lag1, lag(view, 2) OVER w AS view_lag2
    FROM filled WINDOW w AS (PARTITION BY entity ORDER BY period))""",
  "SELECT * FROM lagged WHERE click_lag2 IS NOT NULL AND view_lag2 IS NOT NULL",
                     ["click", "view", "click_lag1", "click_lag2", "view_lag1", "view_lag2"]))
def lag_features(spark, sf_dir) -> DataFrame:
    """Row-shift lags; rows without full history drop out; unknown columns are skipped."""
    panel = P.events_filled(spark, sf_dir).select("entity", "period", "click", "view")
    return O.add_lag_features(panel, ["click", "view", "unknown"], lags=2,
                              segment_rows=P.events_segments(spark, sf_dir))


@query("D1", S.with_(S.PANEL + """, lagged AS (
    SELECT entity, period, view, lag(view, 1) OVER w AS view_lag1
    FROM panel WINDOW w AS (PARTITION BY entity ORDER BY period))""",
  "SELECT * FROM lagged WHERE view IS NOT NULL AND view_lag1 IS NOT NULL", ["view", "view_lag1"]))
def lag_features_split_series(spark, sf_dir) -> DataFrame:
    """The same operator cutting every series into short segments: identical rows."""
    panel = P.events_panel(spark, sf_dir).select("entity", "period", "view")
    return O.add_lag_features(panel, ["view"], lags=1, segment_rows=4)


@query("D2", S.with_(S.FILLED_RAW, f"SELECT entity, period, {TYPES_SQL} FROM filled_raw", TYPES))
def fill_linear(spark, sf_dir) -> DataFrame:
    return O.fill_missing(P.events_panel(spark, sf_dir))


@query("D2", S.with_(S.FILLED_RAW, f"SELECT entity, period, {TYPES_SQL} FROM filled_raw", TYPES))
def fill_linear_split_series(spark, sf_dir) -> DataFrame:
    """Series cut into segments of four days; gaps reach across segments."""
    return O.fill_missing(P.events_panel(spark, sf_dir), segment_rows=4)


@query("D2", S.with_(S.FILLED_RAW, f"SELECT entity, period, {TYPES_SQL} FROM filled_raw", TYPES))
def fill_linear_bounded_series(spark, sf_dir) -> DataFrame:
    """One window per entity, for series of bounded length."""
    return O.fill_missing(P.events_panel(spark, sf_dir), segment_rows=None)


@query("D2", S.with_(S.NEAR, """SELECT entity, period,
    CASE WHEN click IS NOT NULL THEN click WHEN click_v0 IS NULL THEN click_v1 WHEN click_v1 IS NULL THEN click_v0
      ELSE click_v0 + (click_v1 - click_v0) * (period - q0) / (q1 - q0) END AS click
    FROM (SELECT *, last_value(CASE WHEN click IS NOT NULL THEN period END IGNORE NULLS) OVER back AS q0,
                 first_value(CASE WHEN click IS NOT NULL THEN period END IGNORE NULLS) OVER ahead AS q1
          FROM near WINDOW
            back AS (PARTITION BY entity ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
            ahead AS (PARTITION BY entity ORDER BY period ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""",
                     ["click"]))
def fill_linear_by_period(spark, sf_dir) -> DataFrame:
    """Interpolation spaced by the period instead of the row position."""
    return O.fill_missing(P.events_panel(spark, sf_dir).select("entity", "period", "click"), by="period")


@query("D3", S.with_(S.NEAR, "SELECT entity, period, " + ", ".join(
    f"coalesce({c}, {c}_v0, {c}_v1) AS {c}" for c in TYPES) + " FROM near", TYPES))
def fill_forward_backward(spark, sf_dir) -> DataFrame:
    return O.fill_missing(P.events_panel(spark, sf_dir), method="ffill_bfill")


@query("D4", S.with_(S.NEAR, """SELECT entity, period, click,
    CASE WHEN count(click) OVER w = 3 AND n > 3 THEN avg(click) OVER w END AS click_ma
    FROM near WINDOW w AS (PARTITION BY entity ORDER BY period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
                     ["click", "click_ma"]))
def moving_average_gaps(spark, sf_dir) -> DataFrame:
    """Window of three over a column with gaps, series cut into segments."""
    return O.moving_average(P.events_panel(spark, sf_dir).select("entity", "period", "click"), ["click"],
                            window=3, segment_rows=5)


@query("D4", S.with_(S.ORDERS_PANEL, """SELECT entity, period, revenue,
    CASE WHEN count(revenue) OVER w = 5 AND count(*) OVER (PARTITION BY entity) > 5
      THEN avg(revenue) OVER w END AS revenue_ma
    FROM orders_panel WINDOW w AS (PARTITION BY entity ORDER BY period ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
                     ["revenue", "revenue_ma"]))
def moving_average(spark, sf_dir) -> DataFrame:
    return O.moving_average(P.orders_panel(spark, sf_dir).select("entity", "period", "revenue"), ["revenue"],
                            segment_rows=P.order_segments(spark, sf_dir))


@query("D5", S.with_(S.PANEL, """SELECT CASE WHEN period <= 20 THEN 'train' ELSE 'test' END AS split,
    count(*) AS n, min(period) AS first_period, max(period) AS last_period FROM panel GROUP BY 1"""))
def temporal_split(spark, sf_dir) -> DataFrame:
    train, test = O.temporal_split(P.events_panel(spark, sf_dir), 20)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return both.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.min("period").alias("first_period"),
                                     F.max("period").alias("last_period"))


@query("D6", S.with_(S.NEAR, """SELECT entity, period,
    CASE WHEN pos <= floor(CAST(0.8 AS DOUBLE) * n) THEN 'train' ELSE 'test' END AS split FROM near"""))
def proportional_split(spark, sf_dir) -> DataFrame:
    return O.proportional_split(P.events_panel(spark, sf_dir).select("entity", "period"))


FOLD_SQL = """CAST(CASE WHEN pos - 1 < (n % 5) * (n // 5 + 1) THEN (pos - 1) // (n // 5 + 1)
    ELSE n % 5 + (pos - 1 - (n % 5) * (n // 5 + 1)) // greatest(n // 5, 1) END AS INTEGER)"""


@query("D7", S.with_(S.NEAR, f"SELECT entity, period, {FOLD_SQL} AS fold FROM near"))
def contiguous_folds(spark, sf_dir) -> DataFrame:
    return O.contiguous_folds(P.events_panel(spark, sf_dir).select("entity", "period"), 5)


@query("D9", S.with_(S.PANEL, """SELECT entity, period, click, view FROM panel
    QUALIFY row_number() OVER (PARTITION BY entity ORDER BY period DESC) = 1""", ["click", "view"]))
def last_rows(spark, sf_dir) -> DataFrame:
    return O.last_rows(P.events_panel(spark, sf_dir).select("entity", "period", "click", "view"))
