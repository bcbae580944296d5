import pytest
from conftest import rows

from panelwright.operators import columns as C
from panelwright.operators import reshape as R

SPARSE = "entity string, period int, feature1 double, feature2 double, feature3 double, feature4 double, feature5 double"


@pytest.fixture()
def sparse(frame):
    return frame(SPARSE, [
        ("e", 1, 1.0, None, 1.0, 10.0, None), ("e", 2, 2.0, None, 2.0, 20.0, 2.0),
        ("e", 3, None, None, 3.0, 30.0, None), ("e", 4, 4.0, None, None, 40.0, None),
        ("e", 5, 5.0, None, 5.0, 50.0, 5.0)])


def test_sparse_threshold(sparse):
    assert R.drop_sparse_columns(sparse).columns[2:] == ["feature1", "feature3", "feature4"]
    assert R.drop_sparse_columns(sparse, 0.7).columns[2:] == ["feature1", "feature3", "feature4", "feature5"]
    # Exactly at the threshold is kept.
    assert "feature5" in R.drop_sparse_columns(sparse, 0.6).columns
    with pytest.raises(ValueError):
        R.drop_sparse_columns(sparse, 1.5)
    with pytest.raises(ValueError, match="target"):
        R.drop_sparse_columns(sparse, target="feature2")


def test_profile(sparse):
    assert rows(R.profile(sparse, ["feature2", "feature3"]), "column") == [
        ("feature2", 0, 5), ("feature3", 4, 1)]


def test_select_keeps_requested_order(sparse):
    assert C.select_features(sparse, ["feature4", "nope", "feature1"]).columns == [
        "entity", "period", "feature4", "feature1"]


def catalog(frame, names):
    return frame("indicator string", [(n,) for n in names])


def test_choose_target(frame):
    names = ["Annual freshwater withdrawals", "Level of water stress", "Population"]
    assert C.choose_target(catalog(frame, names)) == "Level of water stress"
    assert C.choose_target(catalog(frame, names[:1] + names[2:])) == "Annual freshwater withdrawals"
    assert C.choose_target(catalog(frame, ["Population"])) is None


def test_keywords(frame):
    names = ["Rural population", "Urban population", "Arable land", "Level of water stress",
             "Renewable freshwater", "Annual freshwater withdrawals, total (urban)"]
    assert C.choose_columns_by_keywords(catalog(frame, names)) == [
        "Renewable freshwater", "Rural population", "Urban population", "Arable land"]
    assert len(C.choose_columns_by_keywords(catalog(frame, names), max_features=2)) == 2
    assert len(C.choose_columns_by_keywords(catalog(frame, names), max_features=0)) == 4


def test_modeling_frame(sparse):
    got = C.modeling_frame(sparse, "feature1", features=["feature1", "feature4", "x"])
    assert got.columns == ["entity", "period", "feature4", "feature1"]
    with pytest.raises(ValueError):
        C.modeling_frame(sparse, "absent")


def test_small_selections(sparse):
    assert C.first_features(sparse, "feature2", 2) == ["feature1", "feature3"]
    assert C.numeric_only(sparse).columns == [f"feature{i}" for i in range(1, 6)]
    assert C.period_range(sparse, 2, 3).count() == 2
    assert rows(C.add_year_column(sparse).select("year"), "year")[0] == (1,)
