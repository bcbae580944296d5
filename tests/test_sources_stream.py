import hashlib

import pytest
from conftest import rows
from pyspark.sql import functions as F

from panelwright.models import learners as LN
from panelwright.models import scores as M
from panelwright.models import training as TR
from panelwright.operators import contract as CT
from panelwright.operators.columns import add_year_column
from panelwright.operators import scoring as SC
from panelwright.operators.scoring import score_requests
from panelwright.sources import manifest as MF
from panelwright.sources import reports as RP
from panelwright.sources import runlog as RL
from panelwright.streaming import request_scoring as RS


def test_manifest(spark, tmp_path):
    """Every file's SHA-256, through Spark's reader."""
    folder = tmp_path / "data"
    folder.mkdir()
    for name, text in {"a.csv": "x,y\n1,2\n", "b.csv": "z" * 5000}.items():
        (folder / name).write_text(text)
    built = MF.build_manifest(spark, [str(folder), str(tmp_path / "absent")], "src", "note")
    got = {r["path"].rsplit("/", 1)[1]: r for r in built.collect()}
    assert set(got) == {"a.csv", "b.csv"}
    for name, r in got.items():
        content = (folder / name).read_bytes()
        assert (r["hash"], r["size_bytes"]) == (hashlib.sha256(content).hexdigest(), len(content))
        assert (r["source"], r["description"]) == ("src", "note")


def test_verify_save_load(spark, tmp_path):
    folder = tmp_path / "data"
    folder.mkdir()
    for n in "abc":
        (folder / f"{n}.txt").write_text(n)
    store = str(tmp_path / "manifest")
    MF.save_manifest(MF.build_manifest(spark, [str(folder)]), store)
    (folder / "b.txt").write_text("changed")
    (folder / "c.txt").unlink()
    stored = MF.load_manifest(spark, store)
    now = MF.build_manifest(spark, [str(folder)])
    checked = {r["path"][-5:]: (r["status"], r["is_valid"]) for r in MF.verify_manifest(stored, now).collect()}
    assert checked == {"a.txt": ("ok", True), "b.txt": ("changed", False), "c.txt": ("missing", False)}
    a = stored.filter("path like '%a.txt'").first()["path"]
    assert MF.stored_hash(stored, a) == hashlib.sha256(b"a").hexdigest()
    assert MF.stored_hash(stored, "nowhere") is None
    with pytest.raises(FileNotFoundError):
        MF.load_manifest(spark, str(tmp_path / "none"))
    assert MF.build_manifest(spark, [str(tmp_path / "none")]).count() == 0


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    config = {"split": {"train_end": 2010, "deep": {"x": None}}, "seed": 42}
    for i, (run, r2) in enumerate([("r1", 0.2), ("r2", 0.9), ("r3", 0.9), ("r4", None)]):
        RL.append_runs(RL.run_entries(spark, "exp", run, i, config, {"test.r2": r2} if r2 else {}), path)
    RL.append_runs(RL.run_entries(spark, "other", "r9", 9, {}, {"test.r2": 1.0}), path)
    mine = RL.read_runs(spark, path, "exp")
    assert rows(mine.filter("run_id = 'r1' and kind = 'param'").select("key", "value_str"), "key") == [
        ("seed", "42"), ("split.deep.x", "None"), ("split.train_end", "2010")]
    assert rows(RL.best_run(mine, "test.r2")) == [("exp", "r2", 0.9)]
    assert rows(RL.best_run(mine, "test.r2", "min")) == [("exp", "r1", 0.2)]
    assert RL.best_run(mine, "absent").count() == 0
    assert RL.read_runs(spark, str(tmp_path / "none"), "exp").count() == 0


def test_reports(spark, tmp_path):
    table = RP.metrics_table(spark, {"A": {"MAE": 1, "RMSE": 2.0, "R2": 0.5}, "B": {"MAE": 3.0}})
    path = str(tmp_path / "metrics")
    RP.write_report(table, path)
    assert rows(RP.read_metrics(spark, path), "model") == [("A", 1.0, 2.0, 0.5), ("B", 3.0, None, None)]
    for reader in (RP.read_metrics, RP.read_importance, RP.read_predictions):
        assert reader(spark, str(tmp_path / "none")).count() == 0
    parts = [spark.createDataFrame([("f", 0.5, 1, m)], M.IMPORTANCE_SCHEMA) for m in ("z", "a")]
    assert [r["model"] for r in RP.importance_summary(parts).collect()] == ["a", "z"]


def test_stream_equals_batch(spark, tmp_path):
    contract = CT.Contract(features=(CT.RequestFeature("w", "x", 8.0, 0.0, 100.0),), target="y")
    panel = spark.createDataFrame([("e", 2000 + i, float(i), 3.0 * i) for i in range(8)],
                                  "entity string, period int, x double, y double")
    data = add_year_column(panel)
    models = TR.train_models(data, data, ["year", "x"], "y", [LN.ModelSpec("Ridge", "Ridge")]).models
    asked = spark.createDataFrame([(i, "e", 1995 + i, None if i % 2 else 200.0 * (i == 4), None) for i in range(20)],
                                  "request_id int, entity string, period int, w double, model_name string")
    inbox, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    asked.repartition(4).write.parquet(inbox)

    def run():
        q = RS.start_scoring(RS.request_stream(spark, inbox, asked.schema, files_per_batch=2),
                             panel, models, contract, "Ridge", out, mark)
        q.awaitTermination()

    run()
    keep = ["request_id", "model_used", "prediction", "status"]
    scored, rejected = score_requests(asked, panel, models, contract, "Ridge")
    want = rows(scored.select(*keep), "request_id")
    assert rejected.count() == 1 and len(want) == 19
    assert rows(RS.read_scored(spark, out).select(*keep), "request_id") == want
    # New files are scored by the next run, old ones are not scored again.
    more = asked.filter("request_id = 1").selectExpr("99 as request_id", "entity", "period", "w", "model_name")
    more.write.mode("append").parquet(inbox)
    run()
    assert RS.read_scored(spark, out).count() == 20
    live = RS.validated_stream(RS.request_stream(spark, inbox, asked.schema), contract, ["Ridge"])
    assert live.isStreaming


def scan_paths(plan: str) -> list[list[str]]:
    """For each file scan of a plan's tree: the nodes above it, nearest first."""
    lines = [x for x in plan.splitlines() if x.strip()]
    out, stack = [], []
    for line in lines:
        depth = len(line) - len(line.lstrip(" :+-*("))
        stack = [x for x in stack if x[0] < depth] + [(depth, line.strip(" :+-"))]
        if "FileScan" in line or "Scan parquet" in line:
            out.append([x for _, x in reversed(stack)])
    return out


def test_a_batch_shuffles_no_panel(spark, tmp_path):
    """Joins with the stored serving panel: every exchange is over the requests; few entities are looked up by name."""
    contract = CT.Contract(features=(CT.RequestFeature("w", "x", 8.0, 0.0, 100.0),), target="y")
    panel = spark.range(4000).select((F.col("id") % 50).alias("entity"), (F.col("id") / 50).cast("int").alias("period"),
                                     F.col("id").cast("double").alias("x"), F.lit(1.0).alias("y"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = SC.store_serving_panel(panel, contract, "plan_panel", str(tmp_path / "serving"))
        asked = spark.createDataFrame([(i, i % 7, i, None) for i in range(40)], "request_id long, entity long, period int, w double")
        own = SC.of_batch(stored, asked)
        resolved = SC.resolve_features(asked, own.history, contract, trends=own.trends)
        got = rows(resolved.select("request_id", "w"), "request_id")
        assert got == rows(SC.resolve_features(asked, panel, contract).select("request_id", "w"), "request_id")
        plan = resolved._jdf.queryExecution().executedPlan().toString()
        scans = [p for p in scan_paths(plan) if "plan_panel" in p[0]]
        assert len(scans) == 2
        for path in scans:
            below = path[:next(i for i, n in enumerate(path) if "Join" in n)]
            assert not [n for n in below if "Exchange" in n], path
            assert "In(entity" in path[0] and "Bucketed: true" in path[0]
        many = spark.range(3000).select("id", F.col("id").alias("entity"))
        assert SC.of_batch(stored, many) is stored
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for kind in ("history", "trends"):
            spark.sql(f"DROP TABLE IF EXISTS plan_panel_{kind}")


def test_rows_pass_only_the_model_they_name(spark, tmp_path):
    data = spark.range(30).select(F.lit("e").alias("entity"), F.col("id").cast("int").alias("period"), F.col("id").cast("double").alias("x"),
                                  (F.col("id") * 2.0).alias("y"))
    models = TR.train_models(data, data, ["x"], "y", [LN.ModelSpec("A b", "Ridge"), LN.ModelSpec("B/c", "LinearRegression")]).models
    asked = data.select("period", "x", F.when(F.col("period") < 10, "A b").when(F.col("period") < 20, "B/c").when(F.col("period") < 25, "none").alias("m"))
    got = rows(SC.score_by_own_model(asked, models, ["x"], "m"), "period")
    each = {n: dict(rows(M.score_models(data, {n: model}, ["x"], ["period"]).select("period", "prediction"), "period")) for n, model in models.items()}
    assert got == [(p, x, m, each[m][p] if m in each else None) for p, x, m in rows(asked, "period")]


def test_totals_are_counted_while_writing(spark, tmp_path):
    scored = spark.createDataFrame([(1, "ok"), (2, "failed"), (3, "ok")], "request_id int, status string")
    rejected = spark.createDataFrame([(4,)], "request_id int")
    totals = SC.write_scored(scored, rejected, str(tmp_path / "s"), str(tmp_path / "r"))
    assert rows(totals) == rows(SC.batch_totals(scored, rejected)) == [(4, 2, 2)]
    assert spark.read.parquet(str(tmp_path / "s")).count() == 3
    none = SC.write_scored(scored.where("false"), rejected.where("false"), str(tmp_path / "s0"), str(tmp_path / "r0"))
    assert rows(none) == [(0, 0, 0)]
