"""Registered queries against their oracle SQL on rows that the sample tables lack."""

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as entry_points
from panelwright.plans.registry import NUDGE, rounded

LARGE = [-7.584896e16, -4.823039e16, 2.15398e15, 7.718229e13, -9.386147e13, 3.356042e14, 1e300, 1e305,
         0.0, -2e-9, 12.3456785, -0.0000005, None, float("inf"), float("nan")]


def test_rounding_is_that_of_the_sql(frame):
    """Numbers of more than 2^53 millionths lose their last bit in the SQL's rounding, here too."""
    want = duckdb.sql(f"SELECT round(v + {NUDGE!r}, 6) + 0 FROM (SELECT unnest($1::DOUBLE[]) AS v)", params=[LARGE]).fetchall()
    got = rounded(frame("v double", [(v,) for v in LARGE]), as_sql=True).collect()
    assert [repr(r[0]) for r in got] == [repr(r[0]) for r in want]


@pytest.fixture(scope="module")
def odd_events(spark, tmp_path_factory):
    """User 1 ends on a zero, user 2 has a single day, user 3 a single value of one type beside a longer series."""
    days = {1: [("view", d, v) for d, v in ((1, 4.0), (3, 2.5), (5, 0.0))] + [("click", 2, 7.0), ("click", 9, 3.0), ("error", 9, 1.5)],
            2: [("view", 4, 8.25), ("click", 4, 2.0), ("error", 4, 1.0)],
            3: [("click", 2, 1.0), ("view", 8, 9.0), ("click", 11, 6.0), ("click", 14, 5.0), ("error", 3, 2.0), ("error", 20, 3.5)]}
    folder = tmp_path_factory.mktemp("odd-events")
    rows = [(u, k, d, v) for u, own in days.items() for k, d, v in own]
    data = [(i, dt.datetime(2024, 1, 1, 12) + dt.timedelta(days=d), u, k, v) for i, (u, k, d, v) in enumerate(rows)]
    con = duckdb.connect()
    con.execute("CREATE TABLE events (event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE)")
    con.executemany("INSERT INTO events VALUES (?, ?, ?, ?, ?)", data)
    con.execute(f"COPY events TO '{folder}/events.parquet' (FORMAT parquet)")
    return folder, con


@pytest.mark.parametrize("name", ["scenario_anchored", "scenario_last_step"])
def test_scenarios_of_short_series_and_zeros(spark, odd_events, name):
    folder, con = odd_events
    want = con.sql(entry_points.oracle_sql()[name])
    cols = sorted(want.columns)
    picked = con.sql("SELECT " + ", ".join(f'"{c}"' for c in cols) + " FROM want").fetchall()
    got = [tuple(r) for r in entry_points.queries()[name](spark, str(folder)).select(*cols).collect()]
    assert sorted(map(str, got)) == sorted(map(str, picked))
    assert any(float("-inf") in r for r in got) and {r[cols.index("entity")] for r in got} == {1, 2, 3}
