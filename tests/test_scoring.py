import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from panelwright.models import learners as LN
from panelwright.models import training as TR
from panelwright.operators import contract as CT
from panelwright.operators import ensemble as EN
from panelwright.operators import scoring as G
from panelwright.operators.columns import add_year_column
from panelwright.plans import workflow as WF

W = CT.WATER_STRESS
COLS = [f.column for f in W.features]
REQUEST = ("request_id int, entity string, period int, water_productivity double, "
           "freshwater_withdrawals_agriculture double, freshwater_withdrawals_industry double, "
           "renewable_freshwater_resources double, model_name string")


@pytest.fixture(scope="module")
def history(spark):
    values = [(5.0, 80.0, 3.0, 4.5), (6.0, 78.0, 4.0, 4.4), (7.0, None, 5.0, 4.3), (8.0, 74.0, 6.0, 4.2),
              (9.0, 72.0, 7.0, 4.1)]
    target = [60.0, 61.5, 64.0, 64.5, 70.0]
    schema = "entity string, period int, " + ", ".join(f"`{c}` double" for c in [*COLS, W.target])
    return spark.createDataFrame(
        [("Northland", 2015 + i, *v, t) for i, (v, t) in enumerate(zip(values, target))], schema)


@pytest.fixture(scope="module")
def models(history):
    full = add_year_column(history).fillna(76.0)
    return TR.train_models(full, full, W.model_features, W.target, [
        LN.ModelSpec("Ridge", "Ridge"), LN.ModelSpec("DecisionTree", "DecisionTree")]).models


def codes(frame, scenario=False, **given):
    base = {"request_id": 1, "entity": "e", "period": 2025, "water_productivity": None,
            "freshwater_withdrawals_agriculture": None, "freshwater_withdrawals_industry": None,
            "renewable_freshwater_resources": None, "model_name": None, **given}
    schema = REQUEST + (", method string" if scenario else "")
    if scenario:
        base.setdefault("method", "linear")
    df = frame(schema, [tuple(base.values())])
    row = CT.validate_requests(df, W, ["Lasso", "Ridge"], scenario=scenario).first()
    return row["violations"], row["model_name"]


@pytest.mark.parametrize("given,want", [
    ({}, []), ({"period": 1959}, ["period_range"]), ({"period": 2101}, ["period_range"]),
    ({"period": 1960}, []), ({"period": 2100}, []), ({"period": None}, ["period_missing"]),
    ({"water_productivity": -1.0}, ["water_productivity_range"]),
    ({"water_productivity": 100.0}, []), ({"water_productivity": float("nan")}, ["water_productivity_range"]),
    ({"renewable_freshwater_resources": 1000.5}, ["renewable_freshwater_resources_range"]),
    ({"freshwater_withdrawals_agriculture": 80.0, "freshwater_withdrawals_industry": 30.0}, ["share_sum"]),
    ({"freshwater_withdrawals_agriculture": 80.0, "freshwater_withdrawals_industry": 20.0}, []),
    ({"freshwater_withdrawals_agriculture": 80.0}, []),
    ({"model_name": "m" * 51}, ["model_name_length", "model_unknown"]), ({"model_name": "Other"}, ["model_unknown"]),
])
def test_request_rules(frame, given, want):
    assert codes(frame, **given)[0] == want


def test_model_name_is_tidied(frame):
    assert codes(frame, model_name="  Lasso  ") == ([], "Lasso")
    assert codes(frame, model_name="   ") == ([], None)


def test_scenario_rules(frame):
    assert codes(frame, scenario=True, period=2019)[0] == ["period_range"]
    assert codes(frame, scenario=True, period=2020)[0] == []
    assert codes(frame, scenario=True, method="cubic")[0] == ["method_unknown"]


def test_reserved_column(frame):
    with pytest.raises(ValueError):
        CT.validate_requests(frame("period int, violations string", [(2000, "x")]), W, [])


def test_defaults(frame, history):
    asked = frame(REQUEST, [
        (1, "Northland", 2016, None, None, None, None, None),   # known year
        (2, "Northland", 2017, 1.5, None, None, None, None),    # known year, missing value -> constant
        (3, "Northland", 2020, None, None, 9.0, None, None),    # later year -> trend
        (4, "Northland", 2010, None, None, None, None, None),   # earlier year -> trend backward
        (5, "Elsewhere", 2016, None, None, None, None, None),   # unknown entity -> constants
    ])
    names = [f.name for f in W.features]
    got = {r["request_id"]: [r[n] for n in names] for r in G.resolve_features(asked, history, W).collect()}
    assert got[1] == [6.0, 78.0, 4.0, 4.4]
    assert got[2] == [1.5, 75.0, 5.0, 4.3]
    assert got[3] == [pytest.approx(9.8), pytest.approx(72 - 8 / 4), 9.0, pytest.approx(4.1 - 0.4 / 5)]
    assert got[4][0] == pytest.approx(9 + 0.8 * -9)
    assert got[5] == [8.0, 75.0, 5.0, 4.195]


def test_score_requests(frame, history, models):
    asked = frame(REQUEST, [
        (1, "Northland", 2020, None, None, None, None, " DecisionTree "), (2, "Northland", 2020, 9.8, None, None, None, None),
        (3, "Northland", 1900, None, None, None, None, None)])
    scored, rejected = G.score_requests(asked, history, models, W, "Ridge")
    out = {r["request_id"]: r for r in scored.collect()}
    assert {k: r["model_used"] for k, r in out.items()} == {1: "DecisionTree", 2: "Ridge"}
    assert out[2]["input_features"]["year"] == 2020.0
    assert out[2]["input_features"]["water_productivity"] == 9.8
    assert out[2]["prediction_rounded"] == pytest.approx(out[2]["prediction"], abs=0.005)
    assert rows(rejected.select("request_id")) == [(3,)]
    assert rows(G.batch_totals(scored, rejected)) == [(3, 2, 1)]


def test_defaults_are_joined_without_copies(frame, history):
    """One default row per distinct (entity, period): a popular one is not repeated beforehand."""
    asked = frame(REQUEST, [(i, "Northland", 2016, None, None, None, None, None) for i in range(200)])
    resolved = G.resolve_features(asked, history, W)
    assert resolved.count() == 200
    assert "explode" not in resolved._jdf.queryExecution().optimizedPlan().toString().split("indicator")[0]


def test_scenario_request_defaults(frame, history, models):
    """Neither period nor method: linear, in the contract's year; a known year is extrapolated too."""
    asked = frame("request_id int, entity string, period int, method string, model_name string",
                  [(1, "Northland", None, None, "\tRidge\n"), (2, "Northland", 2030, "linear", " Ridge"), (3, "Northland", 2030, None, "\t")])
    scored, rejected = G.score_scenario_requests(asked, history, models, W, "Ridge")
    out = {r["request_id"]: (r["period"], r["method"], r["model_used"], r["prediction"]) for r in scored.collect()}
    assert out[1] == out[2] == out[3] == (2030, "linear", "Ridge", out[2][3]) and rejected.count() == 0


def test_plain_answers_carry_the_note(frame, history, models):
    asked = frame(REQUEST, [(1, "Northland", 2020, None, None, None, None, None)])
    scored, _ = G.score_requests(asked, history, models, W, "Ridge")
    assert scored.first()["confidence_note"] == G.CONFIDENCE_NOTE


def test_scenario_requests(frame, history, models):
    asked = frame("request_id int, entity string, period int, method string, model_name string",
                  [(1, "Northland", 2030, "linear", None), (2, "Northland", 2030, "cubic", None)])
    scored, rejected = G.score_scenario_requests(asked, history, models, W, "Ridge")
    r = scored.first()
    assert r["input_features"]["water_productivity"] == pytest.approx(9 + 0.8 * 11)
    assert r["interpretation"].startswith("By 2030, Northland is predicted to have ")
    assert f"at {r['prediction']:.1f}%" in r["interpretation"]
    assert rejected.first()["violations"] == ["method_unknown"]


@pytest.mark.parametrize("value,level", [(24.9, "low"), (25.0, "low-medium"), (50.0, "medium-high"),
                                         (75.0, "high"), (100.0, "critical")])
def test_bands(frame, value, level):
    df = frame("p double, y int, e string", [(value, 2030, "Northland")])
    text = df.select(G.interpret(F.col("p"), F.col("y"), F.col("e"))).first()[0]
    assert f"to have {level} water stress at {value:.1f}%. This indicates" in text


def test_year_ranges(frame):
    df = frame("request_id int, start_period int, end_period int",
               [(1, 2000, 2002), (2, 2005, 2004), (3, 1960, 2061), (4, 1960, 2060), (5, 1950, 1970)])
    good, bad = G.year_range_requests(df, W)
    assert {r[0]: r[1] for r in rows(good.groupBy("request_id").count())} == {1: 3, 4: 101}
    assert {r["request_id"]: r["violations"] for r in bad.collect()} == {
        2: ["range_order"], 3: ["range_span"], 5: ["start_range"]}


def test_forecast_run_isolates_a_failing_model(history, models, frame):
    short = history.drop(COLS[3])
    filled = add_year_column(history).fillna(76.0)
    few = ["year", *COLS[:2]]
    fitted = TR.train_models(filled, filled, few, W.target, [LN.ModelSpec("Lasso", "Lasso")]).models
    report, failed = WF.forecast_run(short, {**models, **fitted}, W.model_features, W.target, 2019, 2021, ["linear", "average"])
    assert set(failed) == {"Ridge", "DecisionTree"}
    got = rows(report, "scenario_method")
    assert [(r[1], r[2], r[4], r[5], r[6], r[7]) for r in got] == [
        ("Lasso", 2021, "average", 70.0, 2015, 2019), ("Lasso", 2021, "linear", 70.0, 2015, 2019)]


def test_prepare_features(history):
    df, missing = G.prepare_features(history, ["year", COLS[1], "absent"])
    assert df.columns[-2:] == ["year", COLS[1]] and missing == ["absent"]


def test_ensemble_and_bounds(frame):
    p = frame("model string, prediction double", [("a", 1.0), ("a", 3.0), ("b", 6.0)])
    r = EN.ensemble(p).first()
    assert (r["n_models"], r["mean"], r["std"]) == (2, 4.0, 2.0)
    assert r["lower"] == pytest.approx(4 - 1.96 * 2)
    b = EN.prediction_bounds(p).first()
    v = np.array([1.0, 3.0, 6.0])
    assert b["upper"] == pytest.approx(v.mean() + 1.96 * v.std() / np.sqrt(3))


def test_impute(frame):
    df = frame("entity string, period int, x double", [("a", 1, 1.0), ("a", 2, None), ("b", 1, 5.0), ("c", 1, None)])
    assert rows(EN.impute_mean(df, ["x"]), "entity", "period") == [
        ("a", 1, 1.0), ("a", 2, 3.0), ("b", 1, 5.0), ("c", 1, 3.0)]
    assert rows(EN.impute_mean(df, ["x"], ["entity"]), "entity", "period") == [
        ("a", 1, 1.0), ("a", 2, 1.0), ("b", 1, 5.0), ("c", 1, None)]


def test_training_run_on_a_collinear_panel(spark):
    t = np.linspace(0, 1, 30)
    g = np.random.default_rng(5)
    noise = g.normal(0, 1, 30)
    data = [("e", 1990 + i, float(100 + 50 * t[i]), float(50 + 30 * t[i]), float(noise[i]), float(20 + 40 * t[i] + 5 * noise[i] ** 2))
            for i in range(30)]
    df = spark.createDataFrame(data, "entity string, period int, `urban a` double, `urban b` double, "
                                     "`forest` double, `level of water stress` double")
    run = WF.training_run(df, train_end=2010, lags=1, specs=[LN.ModelSpec("LinearRegression", "LinearRegression")])
    assert run.target == "level of water stress"
    assert rows(run.dropped.select("feature", "kept_feature", "reason")) == [("urban b", "urban a", "collinearity")]
    assert run.features == ["urban a", "forest", "urban a_lag1", "forest_lag1", "year"]
    assert rows(run.trained.predictions.select("period"), "period") == [(p,) for p in range(2011, 2020)]
    again = WF.training_run(df, train_end=2010, lags=1, specs=[LN.ModelSpec("LinearRegression", "LinearRegression")])
    assert rows(again.trained.metrics) == rows(run.trained.metrics)
