"""Registered queries: models, metrics, tuning, importance, ensembles, scenario scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.models import learners as LN
from panelwright.models import per_entity as PE
from panelwright.models import scores as M
from panelwright.models import training as TR
from panelwright.models import tuning as TU
from panelwright.operators import ensemble as EN
from panelwright.operators import extrapolate as X
from panelwright.operators import ordered as O
from panelwright.operators import scoring as G
from panelwright.operators import stats as ST
from panelwright.operators.screening import leakage_alarm
from panelwright.plans import canonical as P
from panelwright.plans import sql as S
from panelwright.plans import workflow as WF
from panelwright.plans.catalog_panel import FOLD_SQL
from panelwright.plans.flagship import flagship
from panelwright.plans.registry import query
from panelwright.session import materialize, scratch_path
from panelwright.sources import reports as RP

FEATURES = ["year", "click", "error"]
TARGET = "view"
TRAIN_END = 20
LINEAR_SPECS = [
    LN.ModelSpec("LinearRegression", "LinearRegression"),
    LN.ModelSpec("Ridge", "Ridge", {"alpha": 50.0}),
]


def split_panel(spark, sf_dir):
    panel = P.events_stored(spark, sf_dir).select("entity", "period", *FEATURES, TARGET)
    return O.temporal_split(panel, TRAIN_END)


def linear_models(spark, sf_dir) -> TR.Trained:
    train, test = split_panel(spark, sf_dir)
    return TR.train_models(train, test, FEATURES, TARGET, LINEAR_SPECS)


@query("F2 F10 D1 D5", S.with_(S.FILLED + """, lagged AS (
    SELECT entity, period, view, lag(click) OVER w AS x1, lag(error) OVER w AS x2, lag(view) OVER w AS x3
    FROM filled WINDOW w AS (PARTITION BY entity ORDER BY period)),
  d AS (SELECT *, period <= 20 AS tr FROM lagged WHERE x1 IS NOT NULL AND x2 IS NOT NULL AND x3 IS NOT NULL),
  m AS (SELECT avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3, avg(view) AS my FROM d WHERE tr),
  c AS (SELECT tr, view, view - my AS y, my, x1 - m1 AS e1, x2 - m2 AS c2, x3 - m3 AS c3 FROM d, m),
  b1 AS (SELECT sum(c2*e1)/sum(e1*e1) AS b21, sum(c3*e1)/sum(e1*e1) AS b31, sum(y*e1)/sum(e1*e1) AS g1 FROM c WHERE tr),
  s2 AS (SELECT c.*, c2 - b21*e1 AS e2, g1, b31 FROM c, b1),
  b2 AS (SELECT sum(c3*e2)/sum(e2*e2) AS b32, sum(y*e2)/sum(e2*e2) AS g2 FROM s2 WHERE tr),
  s3 AS (SELECT s2.*, g2, c3 - b31*e1 - b32*e2 AS e3 FROM s2, b2),
  b3 AS (SELECT sum(y*e3)/sum(e3*e3) AS g3 FROM s3 WHERE tr),
  p AS (SELECT view AS actual, my + g1*e1 + g2*e2 + g3*e3 AS prediction FROM s3, b3 WHERE NOT tr)""",
  """SELECT 'LinearRegression' AS model, avg(abs(actual - prediction)) AS MAE,
     sqrt(avg((actual - prediction)^2)) AS RMSE,
     1 - sum((actual - prediction)^2) / (var_pop(actual) * count(*)) AS R2 FROM p""", ["MAE", "RMSE", "R2"]))
def flagship_lagged_regression(spark, sf_dir) -> DataFrame:
    """Long rows to wide, fill, lag, split by time, standardise, fit, score."""
    return flagship(spark, sf_dir)


@query("F1", S.with_(S.MODELS, "SELECT entity, period, z1 AS year, z2 AS click, z3 AS error FROM z WHERE NOT in_train",
                     ["year", "click", "error"]))
def standardize(spark, sf_dir) -> DataFrame:
    """Population scaling; training statistics applied to the test rows."""
    train, test = split_panel(spark, sf_dir)
    return LN.scaled(test, LN.fit_scaling(train, FEATURES)).select("entity", "period", *FEATURES)


@query("F2 F3 F16 F17", S.with_(S.MODELS, "SELECT entity, period, model, actual, prediction, "
                                "actual - prediction AS residual FROM pred", ["actual", "prediction", "residual"]))
def actual_vs_predicted(spark, sf_dir) -> DataFrame:
    return linear_models(spark, sf_dir).predictions


@query("F10 A5", S.with_(S.MODELS, "SELECT * FROM metrics", ["MAE", "RMSE", "R2"]))
def regression_metrics(spark, sf_dir) -> DataFrame:
    return linear_models(spark, sf_dir).metrics


@query("F10", S.with_(S.MODELS, """SELECT entity, model, avg(abs(actual - prediction)) AS MAE,
    sqrt(avg((actual - prediction)^2)) AS RMSE,
    CASE WHEN min(actual) = max(actual) THEN 0.0::DOUBLE
      ELSE 1 - sum((actual - prediction)^2) / (var_pop(actual) * count(*)) END AS R2
    FROM pred GROUP BY 1, 2""", ["MAE", "RMSE", "R2"]))
def metrics_per_entity(spark, sf_dir) -> DataFrame:
    predictions = linear_models(spark, sf_dir).predictions
    return M.regression_metrics(predictions, "actual", by=["entity", "model"])


@query("F4", S.with_(S.MODELS + """, lz AS (SELECT covar_pop(z2, view) AS c FROM z WHERE in_train)""",
  """SELECT entity, period, my + sign(c) * greatest(abs(c) - 0.5, 0) * z2 AS prediction
     FROM z, st, lz WHERE NOT in_train""", ["prediction"]))
def lasso_one_feature(spark, sf_dir) -> DataFrame:
    """One feature: the lasso weight is the soft-thresholded covariance."""
    train, test = split_panel(spark, sf_dir)
    fitted = TR.train_models(train, test, ["click"], TARGET, [LN.ModelSpec("Lasso", "Lasso", {"alpha": 0.5})])
    return fitted.predictions.select("entity", "period", "prediction")


@query("E4", S.with_(S.LINES_PANEL + """, f AS (
    SELECT avg(charged) AS my, avg(net) AS mx, covar_pop(net, charged) / var_pop(net) AS b
    FROM lines_panel WHERE period <= 50),
  p AS (SELECT charged AS y, my + b * (net - mx) AS p FROM lines_panel, f WHERE period > 50),
  m AS (SELECT 'LinearRegression' AS model, 1 - sum((y - p)^2) / (var_pop(y) * count(*)) AS R2 FROM p)""",
  "SELECT * FROM m WHERE R2 > 0.95", ["R2"]))
def leakage_alarm_on_net(spark, sf_dir) -> DataFrame:
    """A feature that nearly is the target makes the baseline suspiciously good."""
    train, test = O.temporal_split(P.lines_panel(spark, sf_dir), 50)
    fitted = TR.train_models(train, test, ["net"], "charged", LINEAR_SPECS[:1])
    return leakage_alarm(fitted.metrics).select("model", "R2")


@query("F15", S.with_(S.MODELS, "SELECT model, R2 FROM metrics ORDER BY R2 DESC, model LIMIT 1", ["R2"]))
def best_model(spark, sf_dir) -> DataFrame:
    return M.best_model_row(linear_models(spark, sf_dir).metrics)


@query("F18", S.with_(S.MODELS, """SELECT model, round(MAE, 4) AS mae, round(RMSE, 4) AS rmse, round(R2, 4) AS r2,
    model = (SELECT model FROM metrics ORDER BY R2 DESC, model LIMIT 1) AS is_default,
    'year,click,error' AS feature_columns FROM metrics
    UNION ALL SELECT 'Unmeasured', NULL, NULL, NULL, false, 'year,click,error'"""))
def model_listing(spark, sf_dir) -> DataFrame:
    """Every available model, one of them without metrics."""
    listing = M.model_listing(linear_models(spark, sf_dir).metrics, ["LinearRegression", "Ridge", "Unmeasured"], FEATURES)
    return listing.withColumn("feature_columns", F.concat_ws(",", "feature_columns"))


WEIGHTS = """, wl AS (SELECT model, 'year' AS feature, abs(w1) AS i FROM w UNION ALL
  SELECT model, 'click', abs(w2) FROM w UNION ALL SELECT model, 'error', abs(w3) FROM w),
  ni AS (SELECT feature, i / max(i) OVER (PARTITION BY model) AS importance, model FROM wl)"""


@query("F12", S.with_(S.MODELS + WEIGHTS, "SELECT * FROM ni", ["importance"]))
def normalized_importance(spark, sf_dir) -> DataFrame:
    return M.normalized_importance(spark, linear_models(spark, sf_dir).models, FEATURES)


@query("D8 A6", S.with_(S.MODELS + WEIGHTS, """SELECT feature, importance,
    CAST(row_number() OVER (PARTITION BY model ORDER BY importance DESC, feature) AS INTEGER) AS rank, model
    FROM ni ORDER BY model, rank""", ["importance"]))
def ranked_importance(spark, sf_dir) -> DataFrame:
    rows = M.normalized_importance(spark, linear_models(spark, sf_dir).models, FEATURES)
    return RP.importance_summary([M.rank_importance(rows)])


@query("F13", S.with_(S.MODELS + WEIGHTS, """SELECT * FROM ni WHERE feature IN (
    SELECT feature FROM ni GROUP BY 1 ORDER BY avg(importance) DESC, feature LIMIT 2)""", ["importance"]))
def top_features(spark, sf_dir) -> DataFrame:
    rows = M.normalized_importance(spark, linear_models(spark, sf_dir).models, FEATURES)
    return M.top_features(rows, 2).select("feature", "importance", "model")


@query("F14", S.with_(S.MODELS + """, r AS (SELECT min(click) AS lo, max(click) AS hi FROM filled WHERE period > 20),
  g AS (SELECT CAST(i AS INTEGER) AS point, lo + i * (hi - lo) / 29 AS feature_value FROM range(30) AS t(i), r)""",
  """SELECT point, feature_value, (SELECT avg(my + w1*z1 + w3*z3) FROM z, st WHERE NOT in_train)
       + w2 * (feature_value - m2) / s2 AS prediction, 'click' AS feature
     FROM g, w, st WHERE model = 'LinearRegression'""", ["feature_value", "prediction"]))
def partial_dependence(spark, sf_dir) -> DataFrame:
    train, test = split_panel(spark, sf_dir)
    fitted = TR.train_models(train, test, FEATURES, TARGET, LINEAR_SPECS)
    return M.partial_dependence(test, fitted.models["LinearRegression"], FEATURES, "click")


CV = S.MODELS + f""", tp AS (
  SELECT z.*, row_number() OVER (PARTITION BY entity ORDER BY period) AS pos,
         count(*) OVER (PARTITION BY entity) AS n FROM z WHERE in_train),
  tf AS (SELECT z2 AS x, view AS y, {FOLD_SQL} AS fold FROM tp),
  fd AS (SELECT DISTINCT fold AS k FROM tf),
  gr(param_id, alpha) AS (VALUES (0, 0.1::DOUBLE), (1, 100.0::DOUBLE), (2, 10000.0::DOUBLE)),
  ft AS (SELECT k, avg(x) AS mx, avg(y) AS mf, covar_pop(x, y) * count(*) AS sxy, var_pop(x) * count(*) AS sxx
         FROM tf, fd WHERE fold <> k GROUP BY k),
  sc AS (SELECT param_id, alpha, k,
           1 - sum((y - (mf + sxy / (sxx + alpha) * (x - mx)))^2) / (var_pop(y) * count(*)) AS score
         FROM tf JOIN ft ON tf.fold = ft.k, gr GROUP BY 1, 2, 3)"""
RIDGE_GRID = {"alpha": [0.1, 100.0, 10000.0]}


def ridge_search(spark, sf_dir, n_iter: int | None = None) -> TU.TuningResult:
    train, _ = split_panel(spark, sf_dir)
    segments = P.events_segments(spark, sf_dir)
    folded = O.contiguous_folds(train, 5, segment_rows=segments).persist()
    scaling = LN.fit_scaling(folded, ["click"], TARGET)
    found = TU.tune(LN.ModelSpec("Ridge", "Ridge"), folded, ["click"], TARGET, scaling, RIDGE_GRID,
                    n_iter=n_iter)
    folded.unpersist()
    return found


@query("F8 D7 A7", S.with_(CV, "SELECT param_id, alpha, CAST(k AS INTEGER) AS fold, score FROM sc", ["score"]))
def grid_search_scores(spark, sf_dir) -> DataFrame:
    """Fold scores of a ridge grid; the penalty is mapped anew for every fold."""
    scores = ridge_search(spark, sf_dir).scores
    return scores.select("param_id", F.col("params")["alpha"].cast("double").alias("alpha"), "fold", "score")


@query("F8 A7", S.with_(CV + """, sm AS (SELECT param_id, avg(score) AS mean_test_score,
    stddev_pop(score) AS std_test_score FROM sc GROUP BY 1)""",
  "SELECT *, CAST(rank() OVER (ORDER BY mean_test_score DESC) AS INTEGER) AS rank_test_score FROM sm",
  ["mean_test_score", "std_test_score"]))
def grid_search_summary(spark, sf_dir) -> DataFrame:
    results = ridge_search(spark, sf_dir).results
    return results.select("param_id", "mean_test_score", "std_test_score", "rank_test_score")


@query("F8 A7", S.with_(CV + """, sm AS (SELECT alpha, avg(score) AS m FROM sc GROUP BY 1)""",
  """SELECT 'Ridge' AS model, max(m) AS best_score, 'alpha=' || CAST(CAST(arg_max(alpha, m) * 10 AS BIGINT) AS VARCHAR) || '/10'
     AS hyperparameters FROM sm""", ["best_score"]))
def tuning_summary(spark, sf_dir) -> DataFrame:
    """The best parameters of each tuned model."""
    summary = TU.tuning_summary({"Ridge": ridge_search(spark, sf_dir)}, spark)
    tenths = F.regexp_extract("hyperparameters", r": ([0-9.]+)", 1).cast("double") * 10
    return summary.withColumn("hyperparameters", F.concat(F.lit("alpha="), F.round(tenths).cast("long").cast("string"), F.lit("/10")))


TREE_CV = S.LINES_PANEL + f""", tp AS (
    SELECT entity, period AS x, quantity AS y, row_number() OVER (PARTITION BY entity ORDER BY period) AS pos,
           count(*) OVER (PARTITION BY entity) AS n FROM lines_panel WHERE period <= 50),
  tf AS (SELECT x, y, {FOLD_SQL} AS fold FROM tp), fd AS (SELECT DISTINCT fold AS k FROM tf),
  ins AS (SELECT k, x, y FROM tf, fd WHERE fold <> k),
  v AS (SELECT DISTINCT k, x FROM ins),
  c AS (SELECT k, (x + lead(x) OVER (PARTITION BY k ORDER BY x)) / 2.0 AS t FROM v),
  e AS (SELECT k, t, sum(CASE WHEN x <= t THEN y END) AS sl, count(CASE WHEN x <= t THEN 1 END) AS nl,
               sum(CASE WHEN x > t THEN y END) AS sr, count(CASE WHEN x > t THEN 1 END) AS nr
        FROM ins JOIN c USING (k) WHERE t IS NOT NULL GROUP BY k, t),
  leaf(param_id, least) AS (VALUES (0, 1), (1, 40)),
  b AS (SELECT param_id, k, t, sl / nl AS l, sr / nr AS r FROM e, leaf WHERE nl >= least AND nr >= least
        QUALIFY row_number() OVER (PARTITION BY param_id, k ORDER BY sl * sl / nl + sr * sr / nr DESC, t) = 1),
  sc AS (SELECT param_id, k, 1 - sum((y - CASE WHEN x <= t THEN l ELSE r END)^2) / (var_pop(y) * count(*)) AS score
         FROM tf JOIN b ON tf.fold = b.k GROUP BY 1, 2)"""


@query("F8 D7", S.with_(TREE_CV, "SELECT param_id, CAST(k AS INTEGER) AS fold, score FROM sc", ["score"]))
def grid_search_tree(spark, sf_dir) -> DataFrame:
    """Fold scores of stumps with two leaf sizes, through the general search."""
    panel = materialize(P.lines_panel(spark, sf_dir), "lines-panel").withColumn("year", F.col("period"))
    train, _ = O.temporal_split(panel, 50)
    folded = materialize(O.contiguous_folds(train, 5), "folded")
    scaling = LN.fit_scaling(folded, ["year"], "quantity")
    found = TU.tune(LN.ModelSpec("DecisionTree", "DecisionTree", {"max_depth": 1}), folded, ["year"], "quantity", scaling,
                    {"min_samples_leaf": [1, 40]})
    return found.scores.select("param_id", "fold", "score")


# Best split of each fold's training rows, then the best split of either side.
TWO_LEVELS = """ins AS (SELECT k, x, y FROM rows_of),
  v AS (SELECT DISTINCT k, x FROM ins),
  c AS (SELECT k, (x + lead(x) OVER (PARTITION BY k ORDER BY x)) / 2.0 AS t FROM v),
  e AS (SELECT k, t, sum(CASE WHEN x <= t THEN y END) AS sl, count(CASE WHEN x <= t THEN 1 END) AS nl,
               sum(CASE WHEN x > t THEN y END) AS sr, count(CASE WHEN x > t THEN 1 END) AS nr
        FROM ins JOIN c USING (k) WHERE t IS NOT NULL GROUP BY k, t),
  b AS (SELECT k, t, sl / nl AS l, sr / nr AS r, nl, nr FROM e
        QUALIFY row_number() OVER (PARTITION BY k ORDER BY sl * sl / nl + sr * sr / nr DESC, t) = 1),
  side AS (SELECT k, x > t AS up, x, y FROM ins JOIN b USING (k)),
  v2 AS (SELECT DISTINCT k, up, x FROM side),
  c2 AS (SELECT k, up, (x + lead(x) OVER (PARTITION BY k, up ORDER BY x)) / 2.0 AS t2 FROM v2),
  e2 AS (SELECT k, up, t2, sum(CASE WHEN x <= t2 THEN y END) AS sl, count(CASE WHEN x <= t2 THEN 1 END) AS nl,
                sum(CASE WHEN x > t2 THEN y END) AS sr, count(CASE WHEN x > t2 THEN 1 END) AS nr
         FROM side JOIN c2 USING (k, up) WHERE t2 IS NOT NULL GROUP BY k, up, t2),
  b2 AS (SELECT k, up, t2, sl / nl AS l2, sr / nr AS r2 FROM e2
         QUALIFY row_number() OVER (PARTITION BY k, up ORDER BY sl * sl / nl + sr * sr / nr DESC, t2) = 1)"""
# Depth 2, no split of a node with fewer rows than ``least``.
TWO_LEVEL_VALUE = """CASE WHEN nl + nr < least THEN (l * nl + r * nr) / (nl + nr)
    WHEN depth < 2 OR CASE WHEN x > t THEN nr ELSE nl END < least OR t2 IS NULL THEN CASE WHEN x > t THEN r ELSE l END
    WHEN x <= t2 THEN l2 ELSE r2 END"""
SPLIT_LIMIT = 20


@query("F5", S.with_(S.LINES_PANEL + ", rows_of AS (SELECT 0 AS k, period AS x, quantity AS y FROM lines_panel WHERE period <= 50), " + TWO_LEVELS,
  f"""SELECT entity, period, {TWO_LEVEL_VALUE} AS prediction FROM (SELECT entity, period, period AS x, 2 AS depth, {SPLIT_LIMIT} AS least
      FROM lines_panel) JOIN b ON true LEFT JOIN b2 ON b2.up = (x > t)""", ["prediction"]))
def tree_with_split_limit(spark, sf_dir) -> DataFrame:
    """A tree of depth 2 that splits no node of fewer than 20 rows, on all months."""
    panel = materialize(P.lines_panel(spark, sf_dir), "lines-panel").withColumn("year", F.col("period"))
    train, _ = O.temporal_split(panel, 50)
    scaling = LN.fit_scaling(train, ["year"], "quantity")
    spec = LN.ModelSpec("DecisionTree", "DecisionTree", {"max_depth": 2, "min_samples_split": SPLIT_LIMIT})
    model = LN.fit_model(spec, train, ["year"], "quantity", scaling)
    return M.score_models(panel, {"DecisionTree": model}, ["year"], keep=["entity", "period"]).select("entity", "period", "prediction")


SPLIT_CV = S.LINES_PANEL + f""", tp AS (
    SELECT entity, period AS x, quantity AS y, row_number() OVER (PARTITION BY entity ORDER BY period) AS pos,
           count(*) OVER (PARTITION BY entity) AS n FROM lines_panel WHERE period <= 50),
  tf AS (SELECT x, y, {FOLD_SQL} AS fold FROM tp), fd AS (SELECT DISTINCT fold AS k FROM tf),
  rows_of AS (SELECT k, x, y FROM tf, fd WHERE fold <> k), {TWO_LEVELS},
  gr(param_id, depth, least) AS (VALUES (0, 1, 2), (1, 1, {SPLIT_LIMIT}), (2, 2, 2), (3, 2, {SPLIT_LIMIT})),
  sc AS (SELECT param_id, b.k, 1 - sum((y - {TWO_LEVEL_VALUE})^2) / (var_pop(y) * count(*)) AS score
         FROM tf JOIN b ON tf.fold = b.k CROSS JOIN gr LEFT JOIN b2 ON b2.k = b.k AND b2.up = (x > t) GROUP BY 1, 2)"""


def lines_folds(spark, sf_dir):
    panel = materialize(P.lines_panel(spark, sf_dir), "lines-panel").withColumn("year", F.col("period"))
    train, _ = O.temporal_split(panel, 50)
    return materialize(O.contiguous_folds(train, 5), "folded")


@query("F8 F5", S.with_(SPLIT_CV, "SELECT param_id, CAST(k AS INTEGER) AS fold, score FROM sc", ["score"]))
def grid_search_split_limit(spark, sf_dir) -> DataFrame:
    """Two depths and two split limits, all cut out of one fitted tree per fold."""
    folded = lines_folds(spark, sf_dir)
    found = TU.tune(LN.ModelSpec("DecisionTree", "DecisionTree"), folded, ["year"], "quantity", LN.fit_scaling(folded, ["year"], "quantity"),
                    {"max_depth": [1, 2], "min_samples_split": [2, SPLIT_LIMIT]})
    return found.scores.select("param_id", "fold", "score")


BOOST_CV = TREE_CV.replace("leaf(param_id, least) AS (VALUES (0, 1), (1, 40))", "leaf(least) AS (VALUES (1))").replace(
    "param_id, k, t, sl", "k, t, sl").replace("PARTITION BY param_id, k", "PARTITION BY k").split(",\n  sc AS")[0] + """,
  i2 AS (SELECT ins.k, x, y - CASE WHEN x <= t THEN l ELSE r END AS y FROM ins JOIN b USING (k)),
  e2 AS (SELECT k, c.t, sum(CASE WHEN x <= c.t THEN y END) AS sl, count(CASE WHEN x <= c.t THEN 1 END) AS nl,
                sum(CASE WHEN x > c.t THEN y END) AS sr, count(CASE WHEN x > c.t THEN 1 END) AS nr
         FROM i2 JOIN c USING (k) WHERE c.t IS NOT NULL GROUP BY k, c.t),
  b2 AS (SELECT k, t AS t2, sl / nl AS l2, sr / nr AS r2 FROM e2
         QUALIFY row_number() OVER (PARTITION BY k ORDER BY sl * sl / nl + sr * sr / nr DESC, t) = 1),
  gr(param_id, rounds) AS (VALUES (0, 1), (1, 2)),
  sc AS (SELECT param_id, b.k, 1 - sum((y - CASE WHEN x <= t THEN l ELSE r END
             - CASE WHEN rounds = 1 THEN 0 WHEN x <= t2 THEN 0.5 * l2 ELSE 0.5 * r2 END)^2) / (var_pop(y) * count(*)) AS score
         FROM tf JOIN b ON tf.fold = b.k JOIN b2 ON b2.k = b.k CROSS JOIN gr GROUP BY 1, 2)"""


@query("F8 F7", S.with_(BOOST_CV, "SELECT param_id, CAST(k AS INTEGER) AS fold, score FROM sc", ["score"]))
def grid_search_boosting_rounds(spark, sf_dir) -> DataFrame:
    """One and two boosted stumps, both from one fit per fold."""
    folded = lines_folds(spark, sf_dir)
    spec = LN.ModelSpec("GradientBoosting", "GradientBoosting", {"max_depth": 1, "learning_rate": 0.5})
    found = TU.tune(spec, folded, ["year"], "quantity", LN.fit_scaling(folded, ["year"], "quantity"), {"n_estimators": [1, 2]})
    return found.scores.select("param_id", "fold", "score")


# Two-feature lasso by coordinate descent: 400 rounds per penalty and fold.
LASSO_CV = S.MODELS + f""", tp AS (
  SELECT z.*, row_number() OVER (PARTITION BY entity ORDER BY period) AS pos,
         count(*) OVER (PARTITION BY entity) AS n FROM z WHERE in_train),
  tf AS (SELECT z2 AS a, z3 AS b, view AS y, {FOLD_SQL} AS fold FROM tp), fd AS (SELECT DISTINCT fold AS k FROM tf),
  gr(param_id, alpha) AS (VALUES (0, 0.01::DOUBLE), (1, 0.5::DOUBLE), (2, 2.0::DOUBLE)),
  ft AS (SELECT k, avg(a) AS ma, avg(b) AS mb, avg(y) AS mf, var_pop(a) AS va, var_pop(b) AS vb, covar_pop(a, b) AS ab,
                covar_pop(a, y) AS ca, covar_pop(b, y) AS cb FROM tf, fd WHERE fold <> k GROUP BY k),
  cd AS (SELECT param_id, alpha, k, 0 AS round, 0.0::DOUBLE AS wa, 0.0::DOUBLE AS wb, ft.* EXCLUDE (k) FROM gr, ft
    UNION ALL SELECT param_id, alpha, k, round + 1, na, sign(cb - ab * na) * greatest(abs(cb - ab * na) - alpha, 0) / vb, ma, mb, mf, va, vb, ab, ca, cb
    FROM (SELECT *, sign(ca - ab * wb) * greatest(abs(ca - ab * wb) - alpha, 0) / va AS na FROM cd WHERE round < 400)),
  sc AS (SELECT param_id, cd.k, 1 - sum((y - mf - wa * (a - ma) - wb * (b - mb))^2) / (var_pop(y) * count(*)) AS score
         FROM tf JOIN cd ON tf.fold = cd.k WHERE round = 400 GROUP BY 1, 2)"""


@query("F8 F4", S.with_(LASSO_CV, "SELECT param_id, CAST(k AS INTEGER) AS fold, score FROM sc", ["score"]).replace("WITH ", "WITH RECURSIVE ", 1))
def grid_search_lasso(spark, sf_dir) -> DataFrame:
    """Two features, three penalties, five folds, from one pass over the rows."""
    train, _ = split_panel(spark, sf_dir)
    folded = O.contiguous_folds(train, 5, segment_rows=P.events_segments(spark, sf_dir)).persist()
    found = TU.tune(LN.ModelSpec("Lasso", "Lasso"), folded, ["click", "error"], TARGET, LN.fit_scaling(folded, ["click", "error"], TARGET),
                    {"alpha": [0.01, 0.5, 2.0]})
    folded.unpersist()
    return found.scores.select("param_id", "fold", "score")


# The two penalties that seed 42 draws from RIDGE_GRID.
DRAWN_SQL = "gr(param_id, alpha) AS (VALUES (0, 10000.0::DOUBLE), (1, 0.1::DOUBLE)),"
ALL_SQL = "gr(param_id, alpha) AS (VALUES (0, 0.1::DOUBLE), (1, 100.0::DOUBLE), (2, 10000.0::DOUBLE)),"


@query("F9", S.with_(CV.replace(ALL_SQL, DRAWN_SQL), """SELECT param_id, max(alpha) AS alpha,
    avg(score) AS mean_test_score FROM sc GROUP BY 1""", ["mean_test_score"]))
def random_search(spark, sf_dir) -> DataFrame:
    """Two seeded draws from the grid."""
    found = ridge_search(spark, sf_dir, n_iter=2)
    drawn = found.scores.select("param_id", F.col("params")["alpha"].cast("double").alias("alpha")).distinct()
    return found.results.join(drawn, "param_id").select("param_id", "alpha", "mean_test_score")


STUMP = S.LINES_PANEL + """, tr AS (SELECT period AS x, quantity AS y FROM lines_panel WHERE period <= 50),
  v AS (SELECT DISTINCT x FROM tr), c AS (SELECT (x + lead(x) OVER (ORDER BY x)) / 2.0 AS t FROM v),
  e AS (SELECT t, sum(CASE WHEN x <= t THEN y END) AS sl, count(CASE WHEN x <= t THEN 1 END) AS nl,
               sum(CASE WHEN x > t THEN y END) AS sr, count(CASE WHEN x > t THEN 1 END) AS nr
        FROM tr, c WHERE t IS NOT NULL GROUP BY t),
  b AS (SELECT t, sl / nl AS l, sr / nr AS r FROM e ORDER BY sl * sl / nl + sr * sr / nr DESC, t LIMIT 1)"""
STUMP_BODY = """SELECT entity, period, CASE WHEN period <= t THEN l ELSE r END AS prediction
    FROM lines_panel, b WHERE period > 50"""


def stump_run(spark, sf_dir, kind: str, params: dict) -> tuple[TR.Trained, DataFrame]:
    """One split of the month: a learner that takes no random sample must find the best one."""
    panel = materialize(P.lines_panel(spark, sf_dir), "lines-panel").withColumn("year", F.col("period"))
    train, test = O.temporal_split(panel, 50)
    spec = LN.ModelSpec(kind, kind, {"max_depth": 1, **params})
    return TR.train_models(train, test, ["year"], "quantity", [spec]), panel


@query("F5", S.with_(STUMP, STUMP_BODY, ["prediction"]))
def decision_stump(spark, sf_dir) -> DataFrame:
    return stump_run(spark, sf_dir, "DecisionTree", {})[0].predictions.select("entity", "period", "prediction")


@query("F7", S.with_(STUMP, STUMP_BODY, ["prediction"]))
def boosting_of_one_stump(spark, sf_dir) -> DataFrame:
    """The first boosted tree has full weight."""
    fitted, _ = stump_run(spark, sf_dir, "GradientBoosting", {"n_estimators": 1})
    return fitted.predictions.select("entity", "period", "prediction")


@query("F6", S.with_(STUMP, STUMP_BODY, ["prediction"]))
def forest_without_bootstrap(spark, sf_dir) -> DataFrame:
    """Without bootstrap every tree sees all rows, so a forest of stumps is the stump."""
    fitted, _ = stump_run(spark, sf_dir, "RandomForest", {"n_estimators": 5, "bootstrap": False})
    return fitted.predictions.select("entity", "period", "prediction")


SECOND = """, tr2 AS (SELECT x, y - CASE WHEN x <= t THEN l ELSE r END AS y FROM tr, b),
  e2 AS (SELECT c.t, sum(CASE WHEN x <= c.t THEN y END) AS sl, count(CASE WHEN x <= c.t THEN 1 END) AS nl,
                sum(CASE WHEN x > c.t THEN y END) AS sr, count(CASE WHEN x > c.t THEN 1 END) AS nr
         FROM tr2, c WHERE c.t IS NOT NULL GROUP BY c.t),
  b2 AS (SELECT t AS t2, sl / nl AS l2, sr / nr AS r2 FROM e2 ORDER BY sl * sl / nl + sr * sr / nr DESC, t LIMIT 1)"""


@query("F7", S.with_(STUMP + SECOND, """SELECT entity, period, CASE WHEN period <= t THEN l ELSE r END
    + 0.5 * CASE WHEN period <= t2 THEN l2 ELSE r2 END AS prediction FROM lines_panel, b, b2 WHERE period > 50""",
                     ["prediction"]))
def boosting_of_two_stumps(spark, sf_dir) -> DataFrame:
    """The second tree fits the first one's errors and counts by the learning rate."""
    fitted, _ = stump_run(spark, sf_dir, "GradientBoosting", {"n_estimators": 2, "learning_rate": 0.5})
    return fitted.predictions.select("entity", "period", "prediction")


@query("F14", S.with_(STUMP + """, r AS (SELECT min(period) AS lo, max(period) AS hi FROM lines_panel),
  g AS (SELECT CAST(i AS INTEGER) AS point, lo + i * (hi - lo) / 9.0::DOUBLE AS feature_value FROM range(10) AS n(i), r)""",
  """SELECT point, feature_value, CASE WHEN feature_value <= t THEN l ELSE r END AS prediction, 'year' AS feature
     FROM g, b""", ["feature_value", "prediction"]))
def partial_dependence_tree(spark, sf_dir) -> DataFrame:
    fitted, panel = stump_run(spark, sf_dir, "DecisionTree", {})
    return M.partial_dependence(panel, fitted.models["DecisionTree"], ["year"], "year", 10)


@query("F2 F3", S.with_(S.FILLED + """, e AS (SELECT entity, count(*) AS n, regr_slope(view, click) AS b, covar_pop(click, view) AS c,
      var_pop(click) AS v, avg(view) AS my, avg(click) AS mx FROM filled WHERE period <= 20 GROUP BY 1),
  f AS (SELECT *, CASE WHEN v > 0 THEN c / v * n / (n + 2.0) ELSE 0 END AS w FROM e)""",
  """SELECT entity, n AS n_rows, CASE WHEN n >= 8 THEN w END AS weight, CASE WHEN n >= 8 THEN my - w * mx END AS intercept,
     CASE WHEN n >= 8 THEN 'ok' ELSE 'too_few_rows' END AS status FROM f""", ["weight", "intercept"]))
def ridge_per_entity(spark, sf_dir) -> DataFrame:
    """A ridge of its own for every user, those with too few days reported."""
    train, _ = split_panel(spark, sf_dir)
    fitted = PE.fit_per_entity(train, ["click"], TARGET, alpha=2.0, least_rows=8)
    return fitted.select("entity", "n_rows", F.get("weights", F.lit(0)).alias("weight"), "intercept", "status")


@query("F2 F17", S.with_(S.FILLED + """, m AS (SELECT entity, regr_slope(view, click) AS w, regr_intercept(view, click) AS b, avg(view) AS my,
      var_pop(click) AS v, count(*) AS n FROM filled WHERE period <= 20 GROUP BY 1)""",
  """SELECT f.entity, period, view AS actual, CASE WHEN n >= 2 THEN CASE WHEN v > 0 THEN b + w * click ELSE my END END AS prediction
     FROM filled f LEFT JOIN m ON f.entity = m.entity WHERE period > 20""", ["actual", "prediction"]))
def per_entity_predictions(spark, sf_dir) -> DataFrame:
    """Later days by each user's own least squares."""
    train, test = split_panel(spark, sf_dir)
    scored = PE.score_per_entity(test, PE.fit_per_entity(train, ["click"], TARGET), ["click"])
    return scored.select("entity", "period", F.col(TARGET).alias("actual"), "prediction")


@query("F11 D8", S.with_(S.LINES_PANEL + """, tr AS (
    SELECT 'year' AS f, CAST(period AS DOUBLE) AS x, gross AS y FROM lines_panel WHERE period <= 50
    UNION ALL SELECT 'quantity', quantity, gross FROM lines_panel WHERE period <= 50),
  v AS (SELECT DISTINCT f, x FROM tr),
  c AS (SELECT f, (x + lead(x) OVER (PARTITION BY f ORDER BY x)) / 2.0 AS t FROM v),
  e AS (SELECT f, t, sum(CASE WHEN x <= t THEN y END) AS sl, count(CASE WHEN x <= t THEN 1 END) AS nl,
               sum(CASE WHEN x > t THEN y END) AS sr, count(CASE WHEN x > t THEN 1 END) AS nr
        FROM tr JOIN c USING (f) WHERE t IS NOT NULL GROUP BY f, t),
  b AS (SELECT f FROM e ORDER BY sl * sl / nl + sr * sr / nr DESC LIMIT 1)""",
  """SELECT feature, CASE WHEN feature = f THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS importance,
     CAST(CASE WHEN feature = f THEN 1 ELSE 2 END AS INTEGER) AS rank, 'DecisionTree' AS model
     FROM b, (VALUES ('year'), ('quantity')) AS n(feature)""", ["importance"]))
def stump_importance(spark, sf_dir) -> DataFrame:
    """A single split puts all importance on one feature."""
    panel = materialize(P.lines_panel(spark, sf_dir), "lines-panel").withColumn("year", F.col("period"))
    train, test = O.temporal_split(panel, 50)
    return TR.train_models(train, test, ["year", "quantity"], "gross",
                           [LN.ModelSpec("DecisionTree", "DecisionTree", {"max_depth": 1})]).importance


def tree_set(spark, sf_dir) -> TR.Trained:
    train, test = split_panel(spark, sf_dir)
    return TR.train_models(train, test, FEATURES, TARGET, [
        LN.ModelSpec("DecisionTree", "DecisionTree", {"max_depth": 5}),
        LN.ModelSpec("RandomForest", "RandomForest", {"n_estimators": 100, "max_depth": 5}),
        LN.ModelSpec("GradientBoosting", "GradientBoosting", {"max_depth": 3}),
    ])


@query("F5 F6 F7 F16", None)
def tree_metrics(spark, sf_dir) -> DataFrame:
    return tree_set(spark, sf_dir).metrics


@query("F11 D8", None)
def tree_importance(spark, sf_dir) -> DataFrame:
    return tree_set(spark, sf_dir).importance


@query("A9", S.with_(S.MODELS, "SELECT entity, period, model, prediction FROM pred", ["prediction"]))
def saved_models_predict(spark, sf_dir) -> DataFrame:
    """Models written and read back give the same predictions; a damaged and an absent one are passed over."""
    train, test = split_panel(spark, sf_dir)
    fitted = TR.train_models(train, test, FEATURES, TARGET, LINEAR_SPECS)
    folder = scratch_path(spark, "models")
    TR.save_models(fitted.models, folder)
    P.table(spark, sf_dir, "region").select("r_name").write.text(f"{folder}/Damaged/metadata")
    unreadable: dict[str, str] = {}
    again = TR.load_models(spark, folder, ["Damaged", "LinearRegression", "Ridge", "Absent"], unreadable)
    assert list(unreadable) == ["Damaged"]
    return M.score_models(test, again, FEATURES, keep=["entity", "period"])


@query("A5 A10", S.with_(S.MODELS, "SELECT * FROM metrics", ["MAE", "RMSE", "R2"]))
def metrics_report_roundtrip(spark, sf_dir) -> DataFrame:
    """Metrics written as CSV and read with a fixed schema; an absent report adds no rows."""
    path = scratch_path(spark, "metrics")
    RP.write_report(linear_models(spark, sf_dir).metrics, path)
    return RP.read_metrics(spark, path).unionByName(RP.read_metrics(spark, path + "-absent"))


@query("F16 B8 B13 D2 E1 E2 B12 D5", S.with_(S.MODELS, "SELECT * FROM metrics", ["MAE", "RMSE", "R2"]))
def training_run(spark, sf_dir) -> DataFrame:
    """The whole training workflow from the wide panel to metrics."""
    done = WF.training_run(P.events_panel(spark, sf_dir), TARGET, features=["click", "error", "absent"],
                           train_end=TRAIN_END, sparse_threshold=0.7, specs=LINEAR_SPECS)
    return done.trained.metrics


# --- scenarios over models ---------------------------------------------------------

SCENARIO_END = 34
METHODS = X.TREND_METHODS

SCENARIO = S.MODELS + ", " + S.trend_state().split(S.PANEL + ", ")[1].replace("cells AS", "cells AS", 1) + f""",
  sce AS (
    SELECT entity, period, method, max(v) FILTER (WHERE indicator = 'click') AS click,
           max(v) FILTER (WHERE indicator = 'error') AS error
    FROM (SELECT entity, indicator, period, method, {S.LAST_STEP_VALUE.format(last=29)} AS v
          FROM trend, (VALUES ('linear'), ('exponential'), ('last_value'), ('average')) AS me(method),
               range(30, {SCENARIO_END + 1}) AS yr(period)
          WHERE entity IN (SELECT entity FROM filled))
    GROUP BY 1, 2, 3),
  scp AS (
    SELECT entity, CAST(period AS INTEGER) AS period, method, model,
           my + w1 * (period - m1) / s1 + w2 * (click - m2) / s2 + w3 * (error - m3) / s3 AS prediction
    FROM sce, st, w)"""


def steady(df: DataFrame, *names: str) -> DataFrame:
    """Large values to seven digits: exponential trends differ between engines in their last ones."""
    def of(c):
        return F.when(F.abs(c) > 1000, F.format_string("%.6e", c).cast("double")).otherwise(c)
    return df.withColumns({n: of(F.col(n)) for n in names})


def steady_sql(body: str, *names: str) -> str:
    of = ", ".join(f"CASE WHEN abs({n}) > 1000 THEN printf('%.6e', {n})::DOUBLE ELSE {n} END AS {n}" for n in names)
    return f"SELECT * REPLACE ({of}) FROM ({body})"


def scenario_rows(spark, sf_dir) -> DataFrame:
    """Scenario inputs from the raw panel of the users that have a filled series."""
    panel = P.events_panel_stored(spark, sf_dir)
    known = P.events_stored(spark, sf_dir).select("entity").distinct()
    return X.scenario(panel.join(known, "entity", "left_semi"), ["click", "error"], 29, SCENARIO_END, METHODS, on_short="last")


def scenario_scores(spark, sf_dir, target=SCENARIO_END) -> DataFrame:
    scored, failed = G.score_scenarios(scenario_rows(spark, sf_dir), linear_models(spark, sf_dir).models,
                                       FEATURES, target)
    assert not failed
    return scored


@query("G3 G4", S.with_(SCENARIO, steady_sql(f"SELECT * FROM scp WHERE period = {SCENARIO_END}", "prediction"), ["prediction"]))
def scenario_predictions(spark, sf_dir) -> DataFrame:
    """Every model on the target day of every scenario."""
    return steady(scenario_scores(spark, sf_dir), "prediction")


SUMMARY = ["mean", "median", "optimistic", "pessimistic", "std"]
CHANGE = ["current", "avg_prediction", "change", "change_pct"]
COMPARED = ["current", *METHODS, *[f"{m}_vs_linear" for m in METHODS if m != "linear"],
            *[f"{m}_vs_current" for m in METHODS], "spread"]


@query("C13", S.with_(SCENARIO, steady_sql(f"""SELECT method, model, avg(prediction) AS mean,
    quantile_cont(prediction, 0.5) AS median, min(prediction) AS optimistic, max(prediction) AS pessimistic,
    stddev_samp(prediction) AS std FROM scp WHERE period = {SCENARIO_END} GROUP BY 1, 2""", *SUMMARY), SUMMARY))
def prediction_summary(spark, sf_dir) -> DataFrame:
    return steady(ST.prediction_summary(scenario_scores(spark, sf_dir), ["method", "model"]), *SUMMARY)


@query("C14", S.with_(SCENARIO + f""", cur AS (
    SELECT entity, arg_max_null(view, period) AS current FROM panel WHERE period >= 20 GROUP BY 1),
  a AS (SELECT entity, avg(prediction) AS avg_prediction FROM scp WHERE period = {SCENARIO_END} GROUP BY 1)""",
  steady_sql("""SELECT entity, current, avg_prediction, avg_prediction - current AS change,
     (avg_prediction - current) / current * 100 AS change_pct,
     CASE WHEN avg_prediction > current THEN 'increase' WHEN avg_prediction < current THEN 'decrease'
          WHEN current IS NOT NULL THEN 'stable' END AS direction FROM a JOIN cur USING (entity)""", *CHANGE), CHANGE))
def expected_change(spark, sf_dir) -> DataFrame:
    changed = ST.expected_change(scenario_scores(spark, sf_dir), P.events_panel(spark, sf_dir), TARGET, since=20)
    return steady(changed, *CHANGE)


@query("A8", S.with_(SCENARIO + """, h AS (SELECT entity, arg_max(view, period) AS last_value,
    min(period) AS data_start, max(period) AS data_end FROM panel WHERE period <= 29 GROUP BY 1)""",
  steady_sql(f"""SELECT entity, model, period AS prediction_period, prediction, method AS scenario_method,
      last_value, data_start, data_end FROM scp JOIN h USING (entity) WHERE period = {SCENARIO_END}""", "prediction"),
                     ["prediction", "last_value"]))
def forecast_report(spark, sf_dir) -> DataFrame:
    """Prediction beside the last known target and the data range."""
    report = RP.forecast_report(scenario_scores(spark, sf_dir), P.events_panel(spark, sf_dir), TARGET, 29)
    return steady(report, "prediction")


@query("A8 G1 G3 G4", S.with_(SCENARIO + """, h AS (SELECT entity, arg_max(view, period) AS last_value,
    min(period) AS data_start, max(period) AS data_end FROM panel WHERE period <= 29 GROUP BY 1)""",
  steady_sql(f"""SELECT entity, model, period AS prediction_period, prediction, method AS scenario_method,
      last_value, data_start, data_end FROM scp JOIN h USING (entity) WHERE period = {SCENARIO_END}""", "prediction"),
                     ["prediction", "last_value"]))
def forecast_workflow(spark, sf_dir) -> DataFrame:
    """The whole forecast workflow, from the stored wide panel to the report; a model that needs an absent feature is left out."""
    panel = P.events_panel_stored(spark, sf_dir)
    known = P.events_stored(spark, sf_dir)
    models = linear_models(spark, sf_dir).models
    odd = TR.train_models(known.withColumn("absent", F.col("click")), known.withColumn("absent", F.col("click")), ["absent"], TARGET,
                          [LN.ModelSpec("Odd", "LinearRegression")]).models
    report, failed = WF.forecast_run(panel.join(known.select("entity").distinct(), "entity", "left_semi"), {**models, **odd}, FEATURES, TARGET,
                                     29, SCENARIO_END, on_short="last")
    assert list(failed) == ["Odd"]
    return steady(report, "prediction")


@query("G13", S.with_(SCENARIO + """, h AS (SELECT entity, arg_max(view, period) AS current FROM panel GROUP BY 1),
  x AS (SELECT entity, model, max(prediction) FILTER (WHERE method = 'linear') AS linear,
               max(prediction) FILTER (WHERE method = 'exponential') AS exponential,
               max(prediction) FILTER (WHERE method = 'last_value') AS last_value,
               max(prediction) FILTER (WHERE method = 'average') AS average,
               max(prediction) - min(prediction) AS spread FROM scp WHERE period = 34 GROUP BY 1, 2)""",
  steady_sql("""SELECT entity, model, current, linear, exponential, last_value, average,
     exponential - linear AS exponential_vs_linear, last_value - linear AS last_value_vs_linear,
     average - linear AS average_vs_linear, linear - current AS linear_vs_current,
     exponential - current AS exponential_vs_current,
     last_value - current AS last_value_vs_current, average - current AS average_vs_current, spread
     FROM x LEFT JOIN h USING (entity)""", *COMPARED), COMPARED))
def scenario_comparison(spark, sf_dir) -> DataFrame:
    """The same model across methods: against linear, against the last observation, spread."""
    compared = EN.compare_scenarios(scenario_scores(spark, sf_dir),
                                    EN.latest_target(P.events_panel(spark, sf_dir), TARGET), METHODS)
    return steady(compared, *COMPARED)


@query("G13", S.with_(SCENARIO + """, m AS (SELECT model || ' + ' || method AS c, avg(prediction) AS p
    FROM scp WHERE period = 34 GROUP BY model, method)""",
  steady_sql("""SELECT min(p) AS optimistic, arg_min(c, p) AS optimistic_case, max(p) AS pessimistic,
     arg_max(c, p) AS pessimistic_case, max(p) - min(p) AS spread FROM m""", "optimistic", "pessimistic", "spread"),
  ["optimistic", "pessimistic", "spread"]))
def scenario_spread(spark, sf_dir) -> DataFrame:
    return steady(EN.overall_spread(scenario_scores(spark, sf_dir)), "optimistic", "pessimistic", "spread")


@query("G11", S.with_(S.MODELS + ", pm AS (SELECT model, avg(prediction) AS p FROM pred GROUP BY 1)",
  """SELECT count(*) AS n_models, avg(p) AS mean, stddev_pop(p) AS std, avg(p) - 1.96 * stddev_pop(p) AS lower,
     avg(p) + 1.96 * stddev_pop(p) AS upper FROM pm""", ["mean", "std", "lower", "upper"]))
def ensemble(spark, sf_dir) -> DataFrame:
    return EN.ensemble(linear_models(spark, sf_dir).predictions)


@query("G14", S.with_(S.MODELS + ", pm AS (SELECT period, model, avg(prediction) AS p FROM pred GROUP BY 1, 2)",
  """SELECT period, avg(p) AS mean, avg(p) - 1.96 * stddev_pop(p) AS lower,
     avg(p) + 1.96 * stddev_pop(p) AS upper FROM pm GROUP BY period""", ["mean", "lower", "upper"]))
def uncertainty_band(spark, sf_dir) -> DataFrame:
    return EN.uncertainty_band(linear_models(spark, sf_dir).predictions)


@query("G12", S.with_(S.MODELS, """SELECT model, avg(prediction) AS mean,
    avg(prediction) - 1.96 * stddev_pop(prediction) / sqrt(count(*)) AS lower,
    avg(prediction) + 1.96 * stddev_pop(prediction) / sqrt(count(*)) AS upper FROM pred GROUP BY 1""",
                      ["mean", "lower", "upper"]))
def prediction_bounds(spark, sf_dir) -> DataFrame:
    return EN.prediction_bounds(linear_models(spark, sf_dir).predictions, ["model"])


@query("G10", S.with_(S.PANEL, """SELECT entity, period,
    coalesce(click, avg(click) OVER (PARTITION BY entity)) AS click,
    coalesce(view, avg(view) OVER (PARTITION BY entity)) AS view FROM panel""", ["click", "view"]))
def impute_mean_per_entity(spark, sf_dir) -> DataFrame:
    panel = P.events_panel(spark, sf_dir).select("entity", "period", "click", "view")
    return EN.impute_mean(panel, ["click", "view"], ["entity"])


@query("G10", S.with_(S.PANEL, """SELECT entity, period, coalesce(click, avg(click) OVER ()) AS click
    FROM panel""", ["click"]))
def impute_mean(spark, sf_dir) -> DataFrame:
    return EN.impute_mean(P.events_panel(spark, sf_dir).select("entity", "period", "click"), ["click"])
