import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from panelwright.models import learners as LN
from panelwright.models import scores as M
from panelwright.models import training as TR
from panelwright.models import tuning as TU
from panelwright.operators.ordered import contiguous_folds, temporal_split

N = 60
FEATURES = ["x (1)", "x.2", "year"]


def arrays(seed=0):
    g = np.random.default_rng(seed)
    x = np.column_stack([g.normal(5, 2, N), g.normal(-1, 0.5, N), np.arange(N) + 1960.0])
    y = 3 * x[:, 0] - 4 * x[:, 1] + 0.2 * (x[:, 2] - 1990) + g.normal(0, 1, N)
    return x, y


@pytest.fixture(scope="module")
def data(spark):
    x, y = arrays()
    cols = ", ".join(f"`{c}` double" for c in FEATURES)
    return spark.createDataFrame(
        [("e", 1960 + i, *map(float, x[i]), float(y[i])) for i in range(N)],
        f"entity string, period int, {cols}, y double").cache()


def scaled_arrays(train=40):
    x, y = arrays()
    m, s = x[:train].mean(0), x[:train].std(0)
    return (x[:train] - m) / s, y[:train], (x[train:] - m) / s, y[train:]


def ridge(z, y, alpha):
    zc, yc = z - z.mean(0), y - y.mean()
    w = np.linalg.solve(zc.T @ zc + alpha * np.eye(z.shape[1]), zc.T @ yc)
    return w, y.mean() - z.mean(0) @ w


def lasso(z, y, alpha):
    """Plain coordinate descent on mean squares / 2 + alpha * |w|."""
    n, yc, w = len(y), y - y.mean(), np.zeros(z.shape[1])
    zc = z - z.mean(0)
    for _ in range(5000):
        for j in range(len(w)):
            r = zc[:, j] @ (yc - zc @ w + zc[:, j] * w[j]) / n
            w[j] = np.sign(r) * max(abs(r) - alpha, 0) / (zc[:, j] @ zc[:, j] / n)
    return w, y.mean() - z.mean(0) @ w


@pytest.fixture(scope="module")
def trained(data):
    train, test = temporal_split(data, 1999)
    return TR.train_models(train, test, FEATURES, "y", [
        LN.ModelSpec("LinearRegression", "LinearRegression"),
        LN.ModelSpec("Ridge", "Ridge", {"alpha": 7.0}), LN.ModelSpec("Lasso", "Lasso", {"alpha": 0.8}),
        LN.ModelSpec("DecisionTree", "DecisionTree"),
        LN.ModelSpec("RandomForest", "RandomForest", {"n_estimators": 10}),
        LN.ModelSpec("GradientBoosting", "GradientBoosting", {"n_estimators": 5, "max_depth": 3})])


def test_linear_models_match_closed_forms(trained):
    z, y, zt, _ = scaled_arrays()
    for name, (w, b) in {"LinearRegression": ridge(z, y, 0), "Ridge": ridge(z, y, 7.0), "Lasso": lasso(z, y, 0.8)}.items():
        got = [r[0] for r in rows(trained.predictions.filter(f"model = '{name}'").orderBy("period").select("prediction"))]
        np.testing.assert_allclose(got, zt @ w + b, rtol=1e-6, err_msg=name)


def test_metrics_match_numpy(trained):
    _, _, _, y = scaled_arrays()
    for r in trained.metrics.collect():
        p = np.array([x[0] for x in rows(trained.predictions.filter(f"model = '{r['model']}'")
                                         .orderBy("period").select("prediction"))])
        assert r["MAE"] == pytest.approx(np.abs(y - p).mean())
        assert r["RMSE"] == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
        assert r["R2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def test_trees(trained, data):
    imp = trained.importance.collect()
    assert {r["model"] for r in imp} == set(LN.TREE_MODELS)
    for name in LN.TREE_MODELS:
        mine = sorted((r for r in imp if r["model"] == name), key=lambda r: r["rank"])
        assert sum(r["importance"] for r in mine) == pytest.approx(1.0)
        assert [r["rank"] for r in mine] == [1, 2, 3]
        assert [r["importance"] for r in mine] == sorted((r["importance"] for r in mine), reverse=True)
    low, high = data.filter("period < 2000").selectExpr("min(y)", "max(y)").first()
    for r in trained.predictions.filter("model in ('DecisionTree', 'RandomForest')").collect():
        assert low - 1e-9 <= r["prediction"] <= high + 1e-9


def test_unlimited_tree_reproduces_its_training_rows(trained, data):
    train = data.filter("period < 2000")
    tree = {"DecisionTree": trained.models["DecisionTree"]}
    scored = M.score_models(train, tree, FEATURES)
    assert M.regression_metrics(scored, "y").first()["MAE"] == pytest.approx(0.0, abs=1e-9)


def test_same_seed_same_forest(trained, data):
    train, test = temporal_split(data, 1999)
    again = TR.train_models(train, test, FEATURES, "y",
                            [LN.ModelSpec("RandomForest", "RandomForest", {"n_estimators": 10})])
    assert rows(again.predictions, "period") == rows(
        trained.predictions.filter("model = 'RandomForest'"), "period")


def test_scaling_of_a_constant_column(frame):
    train = frame("a double, b double", [(1.0, 4.195), (3.0, 4.195)])
    s = LN.fit_scaling(train, ["a", "b"])
    assert s.scales == [1.0, 1.0]
    assert rows(LN.scaled(frame("a double, b double", [(5.0, 5.195)]), s)) == [(3.0, 1.0)]


def test_missing_training_values_are_named(frame):
    with pytest.raises(ValueError, match="'b'"):
        LN.fit_scaling(frame("a double, b double", [(1.0, None), (2.0, 1.0)]), ["a", "b"])


def test_missing_inputs_score_null(trained, data):
    holes = data.selectExpr(
        "entity", "period", "`x (1)`", "cast(null as double) as `x.2`", "year").limit(2)
    got = M.score_models(holes, trained.models, FEATURES)
    assert {r["prediction"] for r in got.collect()} == {None}


def test_constant_truth(frame):
    df = frame("model string, y double, prediction double",
               [("hit", 2.0, 2.0), ("hit", 2.0, 2.0), ("miss", 2.0, 2.5), ("miss", 2.0, 2.0)])
    assert {r["model"]: r["R2"] for r in M.regression_metrics(df, "y").collect()} == {"hit": 1.0, "miss": 0.0}


def brute_scores(name, fit, alphas):
    z, y, _, _ = scaled_arrays()
    fold = np.repeat(np.arange(5), 8)
    out = {}
    for p, a in enumerate(alphas):
        for k in range(5):
            w, b = fit(z[fold != k], y[fold != k], a)
            e, t = y[fold == k] - z[fold == k] @ w - b, y[fold == k]
            out[(p, k)] = 1 - (e @ e) / ((t - t.mean()) ** 2).sum()
    return out


@pytest.mark.parametrize("kind,fit,alphas", [("Ridge", ridge, [0.01, 5.0, 300.0]), ("Lasso", lasso, [0.01, 0.5])])
def test_grid_search_scores(data, kind, fit, alphas):
    train = contiguous_folds(data.filter("period < 2000"), 5)
    scaling = LN.fit_scaling(train, FEATURES, "y")
    found = TU.tune(LN.ModelSpec(kind, kind), train, FEATURES, "y", scaling, {"alpha": alphas})
    want = brute_scores(kind, fit, alphas)
    got = {(r["param_id"], r["fold"]): r["score"] for r in found.scores.collect()}
    assert got == {k: pytest.approx(v, rel=1e-5) for k, v in want.items()}
    means = [np.mean([want[(p, k)] for k in range(5)]) for p in range(len(alphas))]
    assert found.best_params == {"alpha": alphas[int(np.argmax(means))]}
    assert found.best_score == pytest.approx(max(means), rel=1e-5)
    assert [r["rank_test_score"] for r in found.results.orderBy("param_id").collect()] == [
        sum(m > mine for m in means) + 1 for mine in means]


def test_tree_grid_and_empty_grid(data, spark):
    train = contiguous_folds(data.filter("period < 2000"), 3)
    scaling = LN.fit_scaling(train, FEATURES, "y")
    found = TU.tune(LN.ModelSpec("DecisionTree", "DecisionTree"), train, FEATURES, "y", scaling,
                    {"max_depth": [1, None], "min_samples_leaf": [2]})
    assert found.scores.count() == 6 and found.best_params["max_depth"] in (1, None)
    plain = TU.tune(LN.ModelSpec("LinearRegression", "LinearRegression"), train, FEATURES, "y", scaling)
    assert plain.best_params == {} and plain.best_score is None and plain.scores.count() == 0
    assert [r["model"] for r in TU.tuning_summary({"t": found, "l": plain}, spark).collect()] == ["t"]


def test_random_draws():
    grid = TU.PARAM_GRIDS["RandomForest"]
    assert len(TU.grid_points(grid)) == 108  # with min_samples_split
    assert TU.random_points(grid, 5) == TU.random_points(grid, 5)
    assert len(TU.random_points(grid, 500)) == 108


def test_tuned_training(data):
    train, test = temporal_split(data, 1999)
    done = TR.train_models(contiguous_folds(train, 5), test, FEATURES, "y", [LN.ModelSpec("Ridge", "Ridge")],
                           tune_first=True, folds="fold")
    assert done.tuning["Ridge"].best_params["alpha"] in TU.PARAM_GRIDS["Ridge"]["alpha"]
    assert done.metrics.count() == 1


def test_importance_tables(trained, spark, frame):
    norm = M.normalized_importance(spark, trained.models, FEATURES)
    assert {r[0] for r in rows(norm.groupBy("model").max("importance").select("max(importance)"))} == {1.0}
    table = frame("feature string, importance double, model string",
                  [("a", 1.0, "m"), ("b", 0.2, "m"), ("c", 0.0, "m"), ("a", 0.1, "k"), ("b", 0.8, "k")])
    assert {r["feature"] for r in M.top_features(table, 1).collect()} == {"a"}
    zero = frame("feature string, importance double, model string", [("a", 0.0, "m")])
    assert M.normalize_importance(zero).first()["importance"] == 0.0


def test_partial_dependence(trained, data):
    model = trained.models["Ridge"]
    got = rows(M.partial_dependence(data, model, FEATURES, "x.2", 5), "point")
    x, _ = arrays()
    z, y, _, _ = scaled_arrays()
    w, b = ridge(z, y, 7.0)
    m, s = x[:40].mean(0), x[:40].std(0)
    for k, (point, value, prediction, feature) in enumerate(got):
        moved = x.copy()
        moved[:, 1] = np.linspace(x[:, 1].min(), x[:, 1].max(), 5)[k]
        assert (point, feature) == (k, "x.2")
        assert value == pytest.approx(moved[0, 1])
        assert prediction == pytest.approx((((moved - m) / s) @ w + b).mean())


def test_best_model_and_listing(frame, spark):
    metrics = frame(M.METRICS_SCHEMA, [("Model1", 5.0, 6.0, 0.2), ("Model2", 4.0, 4.5, 0.35), ("Model3", 4.5, 5.0, 0.3)])
    assert M.best_model(metrics) == "Model2"
    assert M.best_model(metrics.filter("false")) == "Lasso"
    assert M.best_model(frame(M.METRICS_SCHEMA, [("B", 1.0, 1.0, 0.5), ("A", 1.0, 1.0, 0.5)])) == "A"
    listing = M.model_listing(metrics, ["Model1", "Model2"], ["year"])
    assert [(r["model"], r["is_default"]) for r in listing.orderBy("model").collect()] == [
        ("Model1", False), ("Model2", True)]
    bare = M.model_listing(metrics, ["Model2", "Unmeasured"], ["year"]).orderBy("model").collect()
    assert [(r["model"], r["r2"], r["is_default"]) for r in bare] == [("Model2", 0.35, True), ("Unmeasured", None, False)]


def test_save_and_load(trained, spark, data, tmp_path):
    folder = str(tmp_path / "models")
    TR.save_models(trained.models, folder)
    back = TR.load_models(spark, folder, [*trained.models, "Absent"])
    assert list(back) == list(trained.models)
    keep = ["period"]
    assert rows(M.score_models(data, back, FEATURES, keep), "model", "period") == rows(
        M.score_models(data, trained.models, FEATURES, keep), "model", "period")
    with pytest.raises(FileNotFoundError):
        TR.load_models(spark, folder, ["Absent"])


def test_tree_queries_boost_a_hundred_rounds(spark):
    from panelwright.plans import catalog_models

    model = catalog_models.tree_set(spark, "/root/testdata/sf0.001").models["GradientBoosting"]
    assert [s.getNumTrees for s in model.stages if hasattr(s, "getNumTrees")] == [100]


# rows of trees over tasks


def test_training_tasks_fill_the_cores_evenly(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    mega = 1 << 17  # rows of one column that make a megabyte
    assert [TR.training_tasks(n, 1, 12) for n in (1, 5 * mega, 13 * mega, 12 * 32 * mega, 12 * 32 * mega + 1)] == [1, 5, 12, 12, 24]
    monkeypatch.setattr(TR, "TASK_BYTES", 1024)
    uneven = spark.range(8000, numPartitions=cores + 1).where("id < 3000 or id % 3 = 0")
    sizes = [r["n"] for r in TR.evenly_spread(uneven, uneven.count()).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == cores and max(sizes) < 1.15 * sum(sizes) / cores


def test_forest_draws_do_not_hang_on_the_layout_of_the_rows(data):
    train, test = temporal_split(data, 1999)
    spec = [LN.ModelSpec("RandomForest", "RandomForest", {"n_estimators": 5, "max_depth": 3})]
    got = [rows(TR.train_models(t, test, FEATURES, "y", spec).predictions.select("period", "prediction"), "period")
           for t in (train, train.orderBy(F.desc("period")), train.repartition(3, "period"))]
    assert got[0] == got[1] == got[2]


# trees cut out of larger ones


def grown(x, y, depth, least_split, least_leaf):
    """Plain greedy regression tree: (feature, threshold, low, high) or a mean."""
    if depth == 0 or len(y) < least_split or len(y) < 2 * least_leaf:
        return y.mean()
    best = None
    for f in range(x.shape[1]):
        seen = np.unique(x[:, f])
        for t in (seen[1:] + seen[:-1]) / 2:
            low = x[:, f] <= t
            if min(low.sum(), (~low).sum()) >= least_leaf:
                score = y[low].sum() ** 2 / low.sum() + y[~low].sum() ** 2 / (~low).sum()
                if best is None or score > best[0] + 1e-9:
                    best = (score, f, t, low)
    if best is None:
        return y.mean()
    _, f, t, low = best
    return f, t, grown(x[low], y[low], depth - 1, least_split, least_leaf), grown(x[~low], y[~low], depth - 1, least_split, least_leaf)


def guess(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def one_feature(spark):
    g = np.random.default_rng(4)
    x = np.arange(60) * 1.0
    y = np.where(x < 9, 50, 0) + np.where(x < 4, 9, 0) + 3 * np.sin(x / 5) + g.normal(0, 0.3, 60)
    return x[:, None], y, spark.createDataFrame([("e", i, float(v), float(w)) for i, (v, w) in enumerate(zip(x, y))],
                                                "entity string, period int, a double, y double")


@pytest.mark.parametrize("split", [5, 12, 100])
@pytest.mark.parametrize("kind", ["DecisionTree", "RandomForest"])
def test_split_limit_matches_a_plain_tree(spark, tmp_path, split, kind):
    x, y, df = one_feature(spark)
    params = {"max_depth": 4, "min_samples_split": split, "min_samples_leaf": 2, "n_estimators": 3, "bootstrap": False}
    model = LN.fit_model(LN.ModelSpec(kind, kind, params), df, ["a"], "y", LN.fit_scaling(df, ["a"], "y"))
    want = [guess(grown(x, y, 4, split, 2), r) for r in x]
    for m in (model, saved(spark, model, str(tmp_path / "m"))):
        got = [r[0] for r in M.score_models(df, {kind: m}, ["a"]).orderBy("period").select("prediction").collect()]
        np.testing.assert_allclose(got, want, rtol=1e-9)
        assert [v for _, v, _ in M.raw_importance(m, ["a"])] == [pytest.approx(0.0 if split > 60 else 1.0)]


def saved(spark, model, folder):
    TR.save_models({"m": model}, folder)
    return TR.load_models(spark, folder, ["m"])["m"]


@pytest.mark.parametrize("kind, params, grid", [
    ("DecisionTree", {}, {"max_depth": [1, 3, None], "min_samples_leaf": [1, 3]}),
    ("RandomForest", {"bootstrap": False}, {"max_depth": [1, 3], "n_estimators": [1, 3]}),
    ("RandomForest", {"n_estimators": 3, "min_samples_leaf": 2}, {"max_depth": [2, 4]}),
    ("GradientBoosting", {"max_depth": 2, "learning_rate": 0.3}, {"n_estimators": [2, 4], "subsample": [0.7]}),
])
def test_cut_models_score_as_separate_fits(data, kind, params, grid):
    """Depths, numbers of trees: what is cut out of the largest fit scores as a fit of its own."""
    train = contiguous_folds(data.filter("period < 2000"), 2).cache()
    scaling = LN.fit_scaling(train, FEATURES, "y")
    spec = LN.ModelSpec(kind, kind, params)
    found = {(r["param_id"], r["fold"]): r["score"] for r in TU.tune(spec, train, FEATURES, "y", scaling, grid).scores.collect()}
    ready = LN.assembler(3).transform(scaling.stage(False).transform(train))
    points = TU.grid_points(grid)
    assert len(found) == 2 * len(points)
    for i, p in enumerate(points):
        for k in range(2):
            learner = LN.build_learner(kind, "y", LN.INPUTS, {**params, **p}, LN.SEED, LN.bins_for(spec, scaling.distinct))
            scored = learner.fit(ready.filter(f"fold <> {k}")).transform(ready.filter(f"fold = {k}"))
            r2 = M.regression_metrics(scored.selectExpr("'m' AS model", "y", "prediction"), "y").first()["R2"]
            assert found[(i, k)] == pytest.approx(r2, rel=1e-9), (p, k)


def test_a_search_fits_the_largest_models_only(monkeypatch, data):
    fitted = []
    build = TU.build_learner
    monkeypatch.setattr(TU, "build_learner", lambda *a: fitted.append(a[3]) or build(*a))
    train = contiguous_folds(data.filter("period < 2000"), 2).cache()
    grid = {"n_estimators": [2, 4, 8], "max_depth": [2, None], "min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 4]}
    found = TU.tune(LN.ModelSpec("RandomForest", "RandomForest"), train, FEATURES, "y", LN.fit_scaling(train, FEATURES, "y"), grid)
    assert found.scores.count() == 2 * 36 and len(fitted) == 2 * 2
    assert all(p["n_estimators"] == 8 and p["max_depth"] is None for p in fitted)
    full = TU.PARAM_GRIDS
    assert len(TU.tree_families(LN.ModelSpec("d", "DecisionTree"), TU.grid_points(full["DecisionTree"]))) == 3
    boosted = TU.grid_points(full["GradientBoosting"])
    assert 3 * len(TU.tree_families(LN.ModelSpec("g", "GradientBoosting"), boosted)) == len(boosted)


def test_lasso_path_and_a_column_without_spread():
    g = np.random.default_rng(2)
    x = g.normal(0, 1, (200, 4))
    x[:, 2] = 0
    x[:, 3] = x[:, 0] + 0.01 * g.normal(0, 1, 200)
    y = 2 * x[:, 0] - x[:, 1] + g.normal(0, 0.1, 200)
    xc, yc = x - x.mean(0), y - y.mean()
    for a, w in zip([0.5, 0.01, 3.0], TU.lasso_path(xc.T @ xc, xc.T @ yc, 200, [0.5, 0.01, 3.0]), strict=True):
        pull = xc.T @ (yc - xc @ w) / 200
        assert w[2] == 0
        assert np.all(np.abs(pull[w == 0]) <= a + 1e-9)
        np.testing.assert_allclose(pull[w != 0], a * np.sign(w[w != 0]), atol=1e-8)


@pytest.mark.parametrize("name", ["LinearRegression", "DecisionTree", "RandomForest", "GradientBoosting"])
@pytest.mark.parametrize("feature", ["x (1)", "year"])
def test_partial_dependence_equals_moved_rows(trained, data, name, feature):
    model, points = trained.models[name], 4
    got = M.partial_dependence(data, model, FEATURES, feature, points).orderBy("point").collect()
    low, high = data.selectExpr(f"min(`{feature}`)", f"max(`{feature}`)").first()
    for k, r in enumerate(got):
        value = low + (high - low) * k / (points - 1)
        moved = data.withColumn(feature, F.lit(value))
        want = M.score_models(moved, {"m": model}, FEATURES).agg(F.avg("prediction")).first()[0]
        assert (r["point"], r["feature"], r["feature_value"]) == (k, feature, pytest.approx(value))
        assert r["prediction"] == pytest.approx(want, rel=1e-9)


def test_partial_dependence_repeats_no_row(trained, data, spark):
    seen = spark.sparkContext.accumulator(0)

    def counting(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    plain = data.select("entity", "period", *[F.col(f"`{f}`").alias(f"f{i}") for i, f in enumerate(FEATURES)])
    counted = plain.mapInArrow(counting, plain.schema).select("entity", "period", *[F.col(f"f{i}").alias(f) for i, f in enumerate(FEATURES)])
    M.partial_dependence(counted, trained.models["RandomForest"], FEATURES, "year", 30).collect()
    assert seen.value <= 2 * N  # the range, and the leaves
