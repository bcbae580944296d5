import numpy as np
import pytest
from conftest import rows

from panelwright.operators import extrapolate as X

SERIES = {
    "long": [(2010 + i, v) for i, v in enumerate([3.0, 4.0, 4.5, None, 6.0, 7.5, 8.0, None])],
    "two": [(2012, 5.0), (2016, 10.0)],
    "one": [(2014, 3.0)],
    "none": [(2014, None)],
    "flat": [(2010 + i, 4.195) for i in range(8)],
    "sign": [(2010, -1.0), (2011, 2.0), (2012, 4.0)],
    "zero": [(2010, 4.0), (2011, 0.0), (2012, 3.0)],
}


def batch_value(series, year, method, last):
    v = np.array([x for p, x in sorted(series) if x is not None and p <= last])
    if len(v) < 2 or v.std() == 0:
        return float(v[-1]) if len(v) else None
    k = min(5, len(v))
    h = year - last
    return {"linear": v[-1] + (v[-1] - v[-k]) / k * h,
            "exponential": v[-1] * (v[-1] / v[-2]) ** h if v[-1] > 0 and v[-2] > 0 else v[-1],
            "average": v.mean(), "last_value": v[-1]}[method]


def serving_value(series, year, method):
    seen = sorted((p, x) for p, x in series if x is not None)
    if len(seen) < 2:
        return None
    v = np.array([x for _, x in seen])
    k = min(5, len(v))
    h = year - seen[-1][0]
    return {"linear": v[-1] + (v[-1] - v[-k]) / k * h,
            "exponential": v[-1] * ((v[-1] / v[-k]) ** (1 / k)) ** h if v[-k] > 0 else v[-1],
            "average": v.mean(), "last_value": v[-1]}[method]


@pytest.fixture()
def panel(frame):
    periods = range(2010, 2018)
    data = [("e", p, *[dict(s).get(p) for s in SERIES.values()]) for p in periods]
    return frame("entity string, period int, " + ", ".join(f"{n} double" for n in SERIES), data)


def test_batch_rule(panel):
    got = X.scenario(panel, list(SERIES), 2016, 2019, X.TREND_METHODS).collect()
    assert len(got) == 3 * 4
    for r in got:
        for name, s in SERIES.items():
            want = batch_value(s, r["period"], r["method"], 2016)
            assert r[name] == (None if want is None else pytest.approx(want)), (name, r["period"], r["method"])


def test_serving_rule(panel):
    got = X.scenario(panel, list(SERIES), 2017, 2020, X.TREND_METHODS, rule="anchored").collect()
    for r in got:
        for name, s in SERIES.items():
            want = serving_value(s, r["period"], r["method"])
            assert r[name] == (None if want is None else pytest.approx(want)), (name, r["period"], r["method"])


def test_hand_value(frame):
    df = frame("entity string, period int, w double", [("e", 2015 + i, 5.0 + i) for i in range(5)])
    assert rows(X.scenario(df, ["w"], 2019, 2020).select("w")) == [(pytest.approx(9.8),)]


def test_short_history(frame):
    df = frame("entity string, period int, w double", [("a", 2015, 1.0), ("b", 2014, 1.0), ("b", 2015, 2.0)])
    with pytest.raises(Exception, match="fewer than two rows"):
        X.scenario(df, ["w"], 2015, 2016).collect()
    assert [r[0] for r in rows(X.scenario(df, ["w"], 2015, 2016, on_short="skip"))] == ["b"]


def test_bad_arguments(panel):
    for bad in ({"methods": ["cubic"]}, {"target_period": 2016}, {"on_short": "drop"}, {"rule": "other"}):
        with pytest.raises(ValueError):
            X.scenario(panel, ["long"], **{"last_period": 2016, "target_period": 2018, **bad})


def test_tail_is_limited_before_the_shuffle(panel):
    plan = X.trend_table(panel, list(SERIES))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
