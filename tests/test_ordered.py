import random

import numpy as np
import pandas as pd
import pytest
from conftest import rows

from panelwright.operators import ordered as O

GAPPY = [("e", 2000, 20.0, 100.0, None), ("e", 2001, None, 110.0, None), ("e", 2002, 22.0, None, 65.0),
         ("e", 2003, 23.0, 130.0, 70.0), ("e", 2004, None, 140.0, 75.0)]
SCHEMA = "entity string, period int, temperature double, precipitation double, humidity double"


def complete(frame):
    return frame(SCHEMA, [("e", 2000 + i, 20.0 + i, 100.0 + 10 * i, 60.0 + 5 * i) for i in range(6)])


def random_panel(frame, seed=1, entities=4, span=60, empty=True):
    """Irregular periods, gaps, one entity with a column that is never filled."""
    rnd = random.Random(seed)
    data = []
    for e in range(entities):
        for p in sorted(rnd.sample(range(-20, span), 35)):
            a = None if rnd.random() < 0.6 else round(rnd.uniform(0, 10), 3)
            b = None if (empty and e == 0) or rnd.random() < 0.4 else round(rnd.uniform(0, 10), 3)
            data.append((f"e{e}", p, a, b))
    rnd.shuffle(data)
    return frame("entity string, period int, a double, b double", data)


def to_pandas(df):
    return df.toPandas().sort_values(["entity", "period"]).reset_index(drop=True)


@pytest.mark.parametrize("segment", [None, 2, 4096])
def test_fill_fixture(frame, segment):
    got = rows(O.fill_missing(frame(SCHEMA, GAPPY), segment_rows=segment), "period")
    assert got == [("e", 2000, 20.0, 100.0, 65.0), ("e", 2001, 21.0, 110.0, 65.0),
                   ("e", 2002, 22.0, 120.0, 65.0), ("e", 2003, 23.0, 130.0, 70.0), ("e", 2004, 23.0, 140.0, 75.0)]


@pytest.mark.parametrize("segment", [None, 1, 3, 7, 4096])
def test_fill_equals_pandas(frame, segment):
    df = random_panel(frame)
    source, got = to_pandas(df), to_pandas(O.fill_missing(df, segment_rows=segment))
    for e, part in source.groupby("entity"):
        want = part[["a", "b"]].astype(float).interpolate(method="linear", limit_direction="both").ffill().bfill()
        np.testing.assert_allclose(got[got.entity == e][["a", "b"]].astype(float).to_numpy(), want.to_numpy())


@pytest.mark.parametrize("segment", [None, 5])
def test_forward_then_backward(frame, segment):
    df = random_panel(frame, 2)
    source, got = to_pandas(df), to_pandas(O.fill_missing(df, method="ffill_bfill", segment_rows=segment))
    for e, part in source.groupby("entity"):
        want = part[["a", "b"]].astype(float).ffill().bfill()
        np.testing.assert_allclose(got[got.entity == e][["a", "b"]].astype(float).to_numpy(), want.to_numpy())


def test_fill_rejects_unknown_options(frame):
    with pytest.raises(ValueError):
        O.fill_missing(complete(frame), method="spline")
    with pytest.raises(ValueError):
        O.fill_missing(complete(frame), by="year")


def test_lags(frame):
    df = complete(frame)
    one = O.add_lag_features(df, ["temperature", "absent"], 1)
    assert one.columns[-1] == "temperature_lag1"
    assert rows(one, "period")[0] == ("e", 2001, 21.0, 110.0, 65.0, 20.0)
    assert one.count() == 5
    assert O.add_lag_features(df, ["temperature"], 3).count() == 3
    assert O.add_lag_features(df, ["absent"], 2).count() == 6


@pytest.mark.parametrize("segment", [None, 1, 3, 4096])
def test_lags_equal_pandas(frame, segment):
    df = random_panel(frame, 3, empty=False)
    got = to_pandas(O.add_lag_features(df, ["a"], 2, segment_rows=segment))
    source = to_pandas(df)
    for k in (1, 2):
        source[f"a_lag{k}"] = source.groupby("entity")["a"].shift(k)
    want = source.dropna().reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


@pytest.mark.parametrize("segment", [None, 2, 4096])
def test_moving_average_equals_pandas(frame, segment):
    df = random_panel(frame, 4)
    got = to_pandas(O.moving_average(df, ["a", "b"], 3, segment_rows=segment))
    source = to_pandas(df)
    for c in ("a", "b"):
        want = source.groupby("entity")[c].transform(lambda s: s.astype(float).rolling(3).mean())
        np.testing.assert_allclose(got[f"{c}_ma"].astype(float), want, equal_nan=True)


def test_short_series_has_no_average(frame):
    df = frame("entity string, period int, a double", [("e", i, float(i)) for i in range(3)])
    assert {r[3] for r in rows(O.moving_average(df, ["a"], 3))} == {None}


@pytest.mark.parametrize("segment", [None, 3])
def test_split_and_folds(frame, segment):
    df = frame("entity string, period int", [("a", i * 2) for i in range(13)] + [("b", i) for i in range(5)])
    split = {(r[0], r[1]): r[2] for r in rows(O.proportional_split(df, segment_rows=segment))}
    assert sum(v == "train" for (e, _), v in split.items() if e == "a") == 10
    assert split[("b", 3)] == "train" and split[("b", 4)] == "test"
    folds = rows(O.contiguous_folds(df, 5, segment_rows=segment), "entity", "period")
    assert [r[2] for r in folds if r[0] == "a"] == [0, 0, 0, 1, 1, 1, 2, 2, 2, 3, 3, 4, 4]
    assert [r[2] for r in folds if r[0] == "b"] == [0, 1, 2, 3, 4]


def test_temporal_split_and_last_rows(frame):
    df = complete(frame)
    train, test = O.temporal_split(df, 2003)
    assert (train.count(), test.count()) == (4, 2)
    assert rows(O.last_rows(df)) == [("e", 2005, 25.0, 150.0, 85.0)]


def test_last_rows_limits_before_the_shuffle(frame):
    plan = O.last_rows(complete(frame))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_other_entities_do_not_matter(frame):
    both = random_panel(frame, 5)
    alone = both.filter("entity = 'e1'")
    want = rows(O.fill_missing(alone), "period")
    assert rows(O.fill_missing(both).filter("entity = 'e1'"), "period") == want


def test_segments_are_chosen_from_the_period_range(frame):
    df = frame("entity string, period int", [("a", 0), ("a", 99)])
    assert O.series_span(df) == 100
    assert O.choose_segments(df, limit=100) is None
    assert O.choose_segments(df, limit=99) == 99


def test_filled_rows_share_one_shuffle(spark, frame):
    df = O.fill_missing(random_panel(frame), segment_rows=4)
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()
