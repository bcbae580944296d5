import random

import numpy as np
import pandas as pd
import pytest
from conftest import rows

from panelwright.functions import crossprod as CP
from panelwright.functions.quantile import exact_median
from panelwright.operators import screening as SC
from panelwright.operators import stats as ST


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 999, 1000, 30001])
def test_exact_median(frame, n):
    rnd = random.Random(n)
    values = [round(rnd.lognormvariate(0, 2), 2) for _ in range(n)]
    df = frame("k string, value double", [("hot", v) for v in values] + [("cold", 1.0), ("cold", None)])
    got = dict(rows(exact_median(df, ["k"])))
    assert got == {"hot": pytest.approx(float(np.median(values))), "cold": 1.0}


def test_median_of_few_distinct_values(frame):
    values = [0.0] * 7000 + [1.0] * 7000 + [5.0] * 3
    df = frame("k string, value double", [("hot", v) for v in values])
    assert exact_median(df, ["k"]).first()["median"] == 1.0


def test_median_of_a_large_group_stays_spread(frame):
    """No join deals the rows of a large group to one task; a null key is a group like any other."""
    values = [float(v * 7919 % 30011) for v in range(30011)]
    df = frame("k string, value double", [(k, v) for k in ("hot", None) for v in values] + [("cold", 2.0)])
    found = exact_median(df, ["k"])
    assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert dict(rows(found)) == {"hot": 15005.0, None: 15005.0, "cold": 2.0}


def test_column_statistics(frame):
    df = frame("entity string, period int, x double", [("e", 3, None), ("e", 1, 1.0), ("e", 2, 4.0)])
    assert rows(ST.column_statistics(df, ["x"])) == [
        ("e", "x", 2.5, 2.5, pytest.approx(2.1213203), 1.0, 4.0, None)]


def panel(frame):
    t = np.linspace(0, 1, 30)
    cols = {"indicator1": 100 + 50 * t, "indicator2": 50 + 30 * t, "indicator3": 200 + 50 * t,
            "water_stress": 20 + 40 * t}
    return frame("entity string, period int, " + ", ".join(f"{c} double" for c in cols),
                 [("e", 1990 + i, *[float(v[i]) for v in cols.values()]) for i in range(30)])


def test_collinear_panel(frame):
    df = panel(frame)
    leak = SC.drop_leaking(df, "water_stress")
    assert leak.names() == ["indicator1", "indicator2", "indicator3"]
    assert leak.data.columns == ["entity", "period", "water_stress"]
    same = SC.drop_collinear(df, "water_stress")
    assert same.data.columns == ["entity", "period", "indicator1", "water_stress"]


def test_greedy_order_hand_case():
    corr = {("a", "b"): 0.96, ("a", "c"): 0.97, ("a", "d"): 0.1, ("b", "c"): 0.99, ("b", "d"): None, ("c", "d"): 0.96}
    # b-c first: c goes.  a-c and c-d are skipped.  a-b: b goes.
    greedy = SC.collinear_features(corr, ["a", "b", "c", "d"], 0.95)
    assert [(r[0], r[1]) for r in greedy] == [("c", "b"), ("b", "a")]
    every = SC.collinear_features(corr, ["a", "b", "c", "d"], 0.95, "any")
    assert sorted(r[0] for r in every) == ["b", "c", "d"]


def test_correlations_equal_pandas_with_gaps_and_constants(frame):
    rnd = random.Random(3)
    data = [("e", i, *[None if rnd.random() < 0.3 else rnd.gauss(0, 1) for _ in range(3)], 4.195) for i in range(50)]
    df = frame("entity string, period int, a double, b double, c double, fixed double", data)
    names = ["a", "b", "c", "fixed"]
    want = pd.DataFrame(data, columns=["entity", "period", *names])[names].astype(float).corr()
    got = {(r["a"], r["b"]): r["corr"] for r in ST.correlation_matrix(df, names).collect()}
    assert len(got) == 16
    for (a, b), v in got.items():
        if "fixed" in (a, b):
            assert v is None
        else:
            assert v == pytest.approx(want.loc[a, b])
    # An unknown correlation never drops a feature.
    assert SC.drop_leaking(df, "fixed").names() == []


def test_wide_matrix_is_tiled(frame, monkeypatch):
    monkeypatch.setattr(ST, "PAIRS_PER_AGGREGATE", 2)
    df = panel(frame)
    assert ST.correlation_matrix(df, ["indicator1", "indicator2", "water_stress"]).count() == 9


def test_reports(frame):
    df = panel(frame)
    top = rows(ST.correlation_report(df, "water_stress", ["indicator1", "water_stress"]))
    assert [(r[0], r[2]) for r in top] == [("indicator1", True), ("water_stress", True)]
    metrics = frame("model string, MAE double, RMSE double, R2 double", [("A", 5.0, 6.0, 0.2), ("B", 4.0, 4.5, None)])
    got = {r["metric"]: r.asDict() for r in ST.best_and_worst(metrics).collect()}
    assert (got["MAE"]["best_model"], got["MAE"]["worst"]) == ("B", 5.0)
    assert got["R2"]["best_model"] == "A"
    assert rows(SC.leakage_alarm(frame("model string, R2 double", [("LinearRegression", 0.96), ("Ridge", 0.99)]))) == [
        ("LinearRegression", 0.96)]


def test_expected_change(frame):
    history = frame("entity string, period int, y double", [("e", 2019, 1.0), ("e", 2021, 50.0), ("f", 2021, 0.0)])
    guess = frame("entity string, prediction double", [("e", 60.0), ("e", 50.0), ("f", 0.0)])
    assert rows(ST.expected_change(guess, history, "y"), "entity") == [
        ("e", 50.0, 55.0, 5.0, pytest.approx(10.0), "increase"), ("f", 0.0, 0.0, 0.0, None, "stable")]


def gappy(frame, n, d, seed, constant=True, mark="c {}.%"):
    g = np.random.default_rng(seed)
    base = g.normal(0, 1, (n, 5)) @ g.normal(0, 1, (5, d)) + g.normal(0, 1, (n, d)) * 0.5 + 1e6 * g.random(d)
    base[g.random((n, d)) < 0.25] = np.nan
    if constant:
        base[:, 0] = 4.195
        base[:, 1] = np.nan
    names = [mark.format(i) for i in range(d)]
    cells = [tuple(None if np.isnan(v) else float(v) for v in r) for r in base]
    return frame(", ".join(f"`{c}` double" for c in names), cells), names, pd.DataFrame(base, columns=names)


@pytest.mark.parametrize("spec", [CP.BlockSpec(), CP.BlockSpec(block=7, memory=48 * 40 * 14, cells=200, fan_in=2)])
def test_blocked_correlations_equal_pandas(frame, spec):
    df, names, pandas = gappy(frame, 400, 40, 1)
    got = {(r["a"], r["b"]): r["corr"] for r in CP.blocked_correlations(df.repartition(9), names, spec).collect()}
    assert set(got) == {(a, b) for i, a in enumerate(names) for b in names[i:]}
    want = pandas.corr()
    for (a, b), v in got.items():
        if a in names[:2] or b in names[:2]:
            assert v is None
        else:
            assert v == pytest.approx(want.loc[a, b], abs=1e-9)


def test_constant_on_common_rows_has_no_correlation(frame):
    rows_ = [(1e9, None), (3.0, 1.0), (3.0, 2.0), (3.0, 4.0), (None, 9.0)]
    df = frame("a double, b double", rows_)
    got = {(r["a"], r["b"]): r["corr"] for r in CP.blocked_correlations(df.repartition(3), ["a", "b"]).collect()}
    assert got[("a", "b")] is None and got[("b", "b")] == pytest.approx(1.0)
    empty = CP.blocked_correlations(frame("a double, b double", []), ["a", "b"]).collect()
    assert empty == [] or {r["corr"] for r in empty} == {None}
    assert CP.blocked_correlations(df, []).count() == 0


def test_three_hundred_columns_take_one_scan(frame, spark):
    """45,150 pairs: one pass over the panel, and blocks instead of rows of pairs between the tasks."""
    df, names, pandas = gappy(frame, 120, 300, 2, constant=False, mark="c{}")
    scans = spark.sparkContext.accumulator(0)

    def counting(batches):
        scans.add(1)
        yield from batches

    seen = df.repartition(2).mapInArrow(counting, df.schema)
    got = ST.correlation_matrix(seen, names)
    values = {(r["a"], r["b"]): r["corr"] for r in got.collect()}
    assert len(values) == 300 * 300 and scans.value == 2  # a task each
    want = pandas.corr()
    for a, b in random.Random(4).sample(sorted(values), 500):
        assert values[(a, b)] == pytest.approx(want.loc[a, b], abs=1e-9)
    plan = got._jdf.queryExecution().toString()
    assert "Aggregate" not in plan
    leak = SC.drop_collinear(df, names[0], threshold=0.97)
    high = {(a, b) for a in names[1:] for b in names[1:] if a < b and abs(want.loc[a, b]) >= 0.97}
    assert {r["feature"] for r in leak.dropped.collect()} <= {x for p in high for x in p}
