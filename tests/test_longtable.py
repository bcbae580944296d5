import pytest
from conftest import rows

from panelwright.operators import reshape as R
from panelwright.sources import longtable as L
from panelwright.sources import panels as PN

RAW = """Country Name,Country Code,Indicator Name,Indicator Code,Year,Value
Northland,NTH,Water Productivity,WP.1,2000,10.5
 northland ,NTH,Water Productivity,WP.1,2001,11.2
Northland,NTH,Water Productivity,WP.1,2002,12.0
Northland,NTH,Population,SP.POP.TOTL,2000,9500000
Northland,NTH,Population,SP.POP.TOTL,2001,9550000
Northland,NTH,Population,SP.POP.TOTL,2002.0,9600000
Southland,STH,Water Productivity,WP.1,2000,15.5
Southland,STH,Population,SP.POP.TOTL,2000,65000000
# Comment line should be skipped
Northland,NTH,Precipitation,PRECIP,2000,500
Northland,NTH,Precipitation,PRECIP,2001,510
Northland,NTH,Precipitation,PRECIP,unknown,1
Northland,NTH,Precipitation,PRECIP,2002,n/a
Northland,NTH,Water Productivity,WP.1,2000,99
"""


@pytest.fixture()
def raw(spark, tmp_path):
    path = tmp_path / "long.csv"
    path.write_text(RAW)
    return L.read_long(spark, str(path))


def one_entity(raw):
    return L.canonical_long(raw).filter("entity_key = 'northland'")


def test_read_and_pivot(raw):
    panel = R.pivot_first(one_entity(raw), entity_cols=["entity_key"])
    assert panel.columns == ["entity_key", "period", "Population", "Precipitation", "Water Productivity"]
    assert rows(panel.drop("entity_key"), "period") == [
        (2000, 9500000.0, 500.0, 10.5), (2001, 9550000.0, 510.0, 11.2), (2002, 9600000.0, None, 12.0)]


def test_entity_filter_ignores_case_and_space(raw):
    assert raw.filter(L.entity_is(" NORTHLAND", "Country Name")).count() == 11


def test_normalised_key_filter_reaches_the_scan(spark, raw, tmp_path):
    path = str(tmp_path / "keys")
    L.canonical_long(raw).drop("ordinal").write.parquet(path)
    plan = spark.read.parquet(path).filter("entity_key = 'northland'")._jdf.queryExecution().toString()
    assert "EqualTo(entity_key,northland)" in plan


def test_header_mismatch_is_an_error(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text(RAW.replace("Indicator Name,Indicator Code", "Indicator Code,Indicator Name", 1))
    with pytest.raises(Exception):
        L.read_long(spark, str(path)).collect()


def test_indicator_list(raw):
    assert R.indicator_names(one_entity(raw)) == ["Population", "Precipitation", "Water Productivity"]


def test_strict_pivot_rejects_duplicates(raw):
    long = one_entity(raw)
    assert rows(R.duplicate_cells(long, ["entity_key"]).select("period", "indicator", "n_rows")) == [
        (2000, "Water Productivity", 2)]
    with pytest.raises(Exception, match="more than once"):
        R.pivot_strict(long, ["entity_key"]).collect()


def test_many_indicators_use_the_two_step_pivot(frame):
    long = frame("entity string, period int, indicator string, value double, ordinal int",
                 [("a", p, f"i{k:03d}", float(k + p), k) for k in range(140) for p in (1, 2)])
    wide = R.pivot_first(long)
    assert len(wide.columns) == 142
    assert wide.filter("period = 2").first()["i139"] == 141.0


def test_shuffled_input_gives_the_same_pivot(raw):
    long = one_entity(raw)
    a = rows(R.pivot_first(long, ["entity_key"]), "period")
    assert rows(R.pivot_first(long.repartition(7), ["entity_key"]), "period") == a


def test_layout_detection(frame):
    long = frame("`Country Name` string, `Indicator Name` string, Year string, Value string",
                 [("Big Northland", "x", "2000", "1"), (None, "x", "2000", "3"), ("South", "x", "2000", "50")])
    assert rows(L.to_panel(long, "Northland")) == [(2000, 2.0)]
    wide = frame("Year string, x string, `y (%)` double", [("2001", "7", 1.0), ("bad", "z", float("nan"))])
    assert rows(L.to_panel(wide), "x") == [(None, None, None), (2001, 7.0, 1.0)]


def test_first_readable_candidate(spark, tmp_path):
    (tmp_path / "b.csv").write_text("Year,x\n2000,1\n")
    df = L.read_any(spark, [str(tmp_path / "a.parquet"), str(tmp_path / "b.csv")])
    assert df.columns == ["Year", "x"]
    with pytest.raises(FileNotFoundError):
        L.read_any(spark, [str(tmp_path / "none.csv")])


def test_metadata_rows(frame):
    df = frame("entity string, v int", [("#country+name", 1), ("a", 2), (None, 3)])
    assert rows(L.drop_metadata_rows(df).select("v"), "v") == [(2,), (3,)]


def test_panel_files(spark, frame, tmp_path):
    df = frame("entity string, period int, `a.b (%)` double", [("x", 2000, 1.5), ("y", 2001, None)])
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        PN.write_panel(df, path, fmt)
        back = PN.read_panel(spark, path, fmt, "period", ["entity"])
        assert rows(back, "entity") == [("x", 2000, 1.5), ("y", 2001, None)]


def test_file_order_over_many_splits(spark, tmp_path):
    """First value in (file, row) order, however the files are cut into tasks."""
    header = RAW.splitlines()[0]
    for f, sign in (("a.csv", 1), ("b.csv", -1)):
        lines = [f"Northland,NTH,x,X,{2000 + i % 50},{sign * i}" for i in range(4000)]
        (tmp_path / f).write_text("\n".join([header, *lines]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        raw = L.read_long(spark, str(tmp_path))
        assert raw.rdd.getNumPartitions() > 4
        panel = R.pivot_first(L.canonical_long(raw))
        assert rows(panel.select("period", "x"), "period") == [(2000 + i, float(i)) for i in range(50)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_line_ends_inside_quotes(spark, tmp_path):
    """Whole rows with ``multiline``; without it the torn halves are reported."""
    header = RAW.splitlines()[0]
    (tmp_path / "a b%20.csv").write_text(header + '\nNorth,N,"say ""x"",\nnow",I,2000,1\n# note\n"North\nland",N,y,I,2001,2\nNorth,N,y,I,bad,3\n')
    (tmp_path / "c.csv").write_text(header + '\nNorth,N,"say ""x"",\nnow",I,2000,9\n')
    raw = L.read_long(spark, str(tmp_path), multiline=True)
    assert dict(raw.dtypes)["ordinal"] == "bigint"
    assert [(r["Indicator Name"], r["Value"]) for r in raw.orderBy("ordinal").collect()] == [
        ('say "x",\nnow', "1"), ("y", "2"), ("y", "3"), ('say "x",\nnow', "9")]
    assert rows(R.pivot_first(L.canonical_long(raw), ["entity_code"]), "period") == [("N", 2000, 1.0, None), ("N", 2001, None, 2.0)]
    assert rows(L.dropped_rows(raw).select("Value", "reason")) == [("3", "no_period")]
    torn = L.dropped_rows(L.read_long(spark, str(tmp_path)))
    assert torn.filter("reason = 'torn'").count() >= 3


def test_pivot_of_a_csv_hashes(raw):
    """The order is one number, so the first value needs no sort around the shuffle."""
    plan = R.pivot_first(L.canonical_long(raw), indicators=["Population", "Precipitation"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
