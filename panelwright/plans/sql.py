"""SQL text shared by the oracle queries (DuckDB dialect)."""

from __future__ import annotations

from panelwright.plans.canonical import EVENT_TYPES, MODEL_TYPES
from panelwright.plans.registry import NUDGE

EV = """ev AS (
  SELECT user_id AS entity,
         CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS period,
         event_type AS indicator, value, event_id AS ordinal
  FROM events)"""

PANEL = EV + """, panel AS (
  SELECT entity, period,
         arg_min(value, ordinal) FILTER (WHERE indicator = 'click') AS click,
         arg_min(value, ordinal) FILTER (WHERE indicator = 'error') AS error,
         arg_min(value, ordinal) FILTER (WHERE indicator = 'purchase') AS purchase,
         arg_min(value, ordinal) FILTER (WHERE indicator = 'signup') AS signup,
         arg_min(value, ordinal) FILTER (WHERE indicator = 'view') AS view
  FROM ev WHERE value IS NOT NULL GROUP BY entity, period)"""


def _near(c: str) -> str:
    return f"""
         last_value({c} IGNORE NULLS) OVER back AS {c}_v0,
         last_value(CASE WHEN {c} IS NOT NULL THEN pos END IGNORE NULLS) OVER back AS {c}_p0,
         first_value({c} IGNORE NULLS) OVER ahead AS {c}_v1,
         first_value(CASE WHEN {c} IS NOT NULL THEN pos END IGNORE NULLS) OVER ahead AS {c}_p1"""


def _linear(c: str) -> str:
    return (f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN {c}_v0 IS NULL THEN {c}_v1 "
            f"WHEN {c}_v1 IS NULL THEN {c}_v0 "
            f"ELSE {c}_v0 + ({c}_v1 - {c}_v0) * (pos - {c}_p0) / ({c}_p1 - {c}_p0) END AS {c}")


NEAR = PANEL + f""", placed AS (
  SELECT *, row_number() OVER (PARTITION BY entity ORDER BY period) AS pos,
         count(*) OVER (PARTITION BY entity) AS n FROM panel),
near AS (
  SELECT *,{','.join(_near(c) for c in EVENT_TYPES)}
  FROM placed WINDOW
    back AS (PARTITION BY entity ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    ahead AS (PARTITION BY entity ORDER BY period ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""

FILLED_RAW = NEAR + f""", filled_raw AS (
  SELECT entity, period, {', '.join(_linear(c) for c in EVENT_TYPES)} FROM near)"""

FILLED = FILLED_RAW + f""", filled AS (
  SELECT *, period AS year FROM filled_raw
  WHERE {' AND '.join(c + ' IS NOT NULL' for c in MODEL_TYPES)})"""

ORDERS_PANEL = """orders_panel AS (
  SELECT c_mktsegment AS entity,
         CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS INTEGER) AS period,
         count(*) AS n_orders, sum(o_totalprice) / 1000 AS revenue,
         avg(o_totalprice) / 1000 AS mean_price,
         avg(CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0 ELSE 0.0 END) AS urgent_share
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""

LINES_PANEL = """lines_panel AS (
  SELECT l_returnflag AS entity,
         CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) AS INTEGER) AS period,
         sum(l_extendedprice) AS gross,
         sum(l_extendedprice * (1 - l_discount)) AS net,
         sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS charged,
         sum(l_quantity) AS quantity,
         avg(l_discount) AS discount, avg(l_tax) AS tax
  FROM lineitem GROUP BY 1, 2)"""

# Least squares and ridge on the standardised features (year, click, error),
# target view, trained on days up to 20: closed form of the 3 x 3 system.
MODELS = FILLED + """, st AS (
  SELECT CAST(count(*) AS DOUBLE) AS nt, avg(year) AS m1, stddev_pop(year) AS s1,
         avg(click) AS m2, stddev_pop(click) AS s2, avg(error) AS m3, stddev_pop(error) AS s3,
         avg(view) AS my FROM filled WHERE period <= 20),
z AS (
  SELECT entity, period, view, year, click, error, period <= 20 AS in_train,
         (year - m1) / s1 AS z1, (click - m2) / s2 AS z2, (error - m3) / s3 AS z3
  FROM filled, st),
cv AS (
  SELECT covar_pop(z1, z2) AS r12, covar_pop(z1, z3) AS r13, covar_pop(z2, z3) AS r23,
         covar_pop(z1, view) AS c1, covar_pop(z2, view) AS c2, covar_pop(z3, view) AS c3
  FROM z WHERE in_train),
al(model, alpha) AS (VALUES ('LinearRegression', 0.0::DOUBLE), ('Ridge', 50.0::DOUBLE)),
sys AS (SELECT model, 1 + alpha / nt AS a, cv.* FROM al, st, cv),
w AS (
  SELECT model,
    ((a*a - r23*r23)*c1 + (r13*r23 - a*r12)*c2 + (r12*r23 - a*r13)*c3) / det AS w1,
    ((r13*r23 - a*r12)*c1 + (a*a - r13*r13)*c2 + (r12*r13 - a*r23)*c3) / det AS w2,
    ((r12*r23 - a*r13)*c1 + (r12*r13 - a*r23)*c2 + (a*a - r12*r12)*c3) / det AS w3
  FROM (SELECT *, a*a*a + 2*r12*r13*r23 - a*(r12*r12 + r13*r13 + r23*r23) AS det FROM sys)),
pred AS (
  SELECT entity, period, model, view AS actual, my + w1*z1 + w2*z2 + w3*z3 AS prediction
  FROM z, w, st WHERE NOT in_train),
metrics AS (
  SELECT model, avg(abs(actual - prediction)) AS MAE, sqrt(avg((actual - prediction)^2)) AS RMSE,
         1 - sum((actual - prediction)^2) / (var_pop(actual) * count(*)) AS R2
  FROM pred GROUP BY model)"""

# Trends of every user and event type: last five observations and totals.
TREND = PANEL + f""", cells AS (
  {' UNION ALL '.join(f"SELECT entity, period, '{c}' AS indicator, {c} AS v FROM panel" for c in EVENT_TYPES)})"""


def trend_state(horizon_filter: str = "true") -> str:
    return TREND + f""", obs AS (SELECT * FROM cells WHERE {horizon_filter}),
tot AS (SELECT entity, indicator, count(*) AS n_rows, count(v) AS n, avg(v) AS mean,
               min(v) AS low, max(v) AS high FROM obs GROUP BY 1, 2),
rk AS (SELECT *, row_number() OVER (PARTITION BY entity, indicator ORDER BY period DESC) AS r
       FROM obs WHERE v IS NOT NULL),
tail AS (SELECT entity, indicator, max(v) FILTER (WHERE r = 1) AS last,
                max(v) FILTER (WHERE r = 2) AS previous, max(period) AS last_seen
         FROM rk GROUP BY 1, 2),
old AS (SELECT rk.entity, rk.indicator, rk.v AS oldest, rk.r AS span FROM rk
        JOIN tot USING (entity, indicator) WHERE rk.r = least(5, tot.n)),
trend AS (SELECT * FROM tot LEFT JOIN tail USING (entity, indicator)
          LEFT JOIN old USING (entity, indicator))"""


LAST_STEP_VALUE = """CASE WHEN n < 2 OR low = high THEN last
    WHEN method = 'linear' THEN last + (last - oldest) / span * (period - {last})
    WHEN method = 'exponential' THEN CASE WHEN last > 0 AND previous > 0
      THEN last * pow(last / previous, period - {last}) ELSE last END
    WHEN method = 'average' THEN mean ELSE last END"""

ANCHORED_VALUE = """CASE WHEN n < 2 THEN NULL
    WHEN method = 'linear' THEN last + (last - oldest) / span * (period - last_seen)
    WHEN method = 'exponential' THEN CASE WHEN oldest > 0
      THEN last * pow(pow(last / oldest, 1.0 / span), period - last_seen) ELSE last END
    WHEN method = 'average' THEN mean ELSE last END"""


def with_(ctes: str, body: str, doubles: list[str] = (), digits: int = 6) -> str:
    """``WITH ctes body`` with the named columns rounded (and no negative zero)."""
    if not doubles:
        return f"WITH {ctes} {body}"
    replaced = ", ".join(f"round({d} + {NUDGE!r}, {digits}) + 0 AS {d}" for d in doubles)
    return f"WITH {ctes} SELECT * REPLACE ({replaced}) FROM ({body})"
