"""Registered queries against their oracle SQL on the smallest tables."""

import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from panelwright.plans import catalog

SF = Path("/root/testdata/sf0.001")

ORACLES = sorted(catalog.oracle_sql())


def test_every_blueprint_operator_has_a_query():
    wanted = ([f"A{i}" for i in range(1, 12)] + [f"B{i}" for i in range(1, 14)] + [f"C{i}" for i in range(1, 15)]
              + [f"D{i}" for i in range(1, 10)] + [f"E{i}" for i in range(1, 5)] + [f"F{i}" for i in range(1, 19)]
              + [f"G{i}" for i in range(1, 15)] + [f"H{i}" for i in range(1, 6)] + ["S1"])
    assert [i for i in wanted if i not in catalog.coverage()] == []


def test_oracle_keys_are_queries():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.skipif(not SF.exists(), reason="sample tables absent")
@pytest.mark.parametrize("name", ORACLES)
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for f in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    got = entry_points.queries()[name](spark, str(SF))
    want = con.sql(entry_points.oracle_sql()[name])
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols

    def norm(table):
        return sorted((tuple(r) for r in table), key=lambda r: [(v is None, str(v)) for v in r])

    picked = ", ".join('"' + c + '"' for c in cols)
    assert norm(got.select(*cols).collect()) == norm(con.sql(f"SELECT {picked} FROM want").fetchall())


@pytest.mark.skipif(not SF.exists(), reason="sample tables absent")
def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["model", "MAE", "RMSE", "R2"] and df.count() == 1


def test_no_row_udfs_or_collect_in_operators():
    root = Path(__file__).resolve().parent.parent / "panelwright"
    folders = ("operators", "functions", "sources", "models", "streaming")
    for path in [p for folder in folders for p in root.glob(f"{folder}/*.py")]:
        text = path.read_text()
        assert not re.search(r"F\.udf|@udf|\.rdd\b|crossJoin|localCheckpoint|toPandas", text), path
