import hashlib
import os
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.models import per_entity as PE
from panelwright.sources import manifest as MF
from panelwright.sources import panels as PN


def entities(spark, seed=1):
    g = np.random.default_rng(seed)
    rows = []
    for e, n in (("a", 30), ("b", 12), ("few", 2), ("flat", 20), ("none", 5), (None, 10)):
        x = g.normal(5, 2, (n, 3)) + 1e6 * (e == "b")
        y = 3 * x[:, 0] - x[:, 1] + g.normal(0, 0.1, n)
        if e == "flat":
            x[:, 1] = 4.195
        for i in range(n):
            missing = e == "none" or (e == "a" and i % 7 == 0)
            rows.append((e, i, *map(float, x[i, :2]), None if missing else float(x[i, 2]), float(y[i]), "extra"))
    names = ["x 1", "x.2", "x3"]
    return spark.createDataFrame(rows, "entity string, period int, `x 1` double, `x.2` double, x3 double, y double, n_rows string"), names


def by_hand(rows, alpha):
    x, y = np.array([r[:-1] for r in rows]), np.array([r[-1] for r in rows])
    s = x.std(0)
    s[s <= 1e-14 * np.abs(x.mean(0))] = 1
    z, yc = (x - x.mean(0)) / s, y - y.mean()
    w = np.linalg.lstsq(np.vstack([z, np.sqrt(alpha) * np.eye(3)]), np.append(yc, np.zeros(3)), rcond=None)[0] / s
    return w, y.mean() - w @ x.mean(0)


@pytest.mark.parametrize("alpha", [0.0, 3.0])
def test_models_per_entity_match_numpy(spark, alpha):
    df, names = entities(spark)
    got = {r["entity"]: r for r in PE.fit_per_entity(df.repartition(5), names, "y", alpha).collect()}
    assert set(got) == {"a", "b", "few", "flat", "none", None}
    rows = [r for r in df.select("entity", *[F.col(f"`{n}`") for n in names], "y").collect() if r["x3"] is not None]
    for e in ("a", "b", "flat", None):
        own = [tuple(r)[1:] for r in rows if r["entity"] == e]
        w, b = by_hand(own, alpha)
        assert got[e]["n_rows"] == len(own) and got[e]["status"] == "ok"
        np.testing.assert_allclose(got[e]["weights"], w, rtol=1e-6, atol=1e-7)
        assert got[e]["intercept"] == pytest.approx(b, rel=1e-5, abs=1e-4)
    assert got["flat"]["weights"][1] == 0.0
    for e, n in (("few", 2), ("none", 0)):
        assert (got[e]["status"], got[e]["weights"], got[e]["n_rows"]) == ("too_few_rows", None, n)


def test_scores_per_entity(spark):
    df, names = entities(spark)
    fitted = PE.fit_per_entity(df, names, "y")
    scored = PE.score_per_entity(df, fitted, names)
    assert scored.columns == [*df.columns, "prediction"] and scored.count() == df.count()
    error = scored.where("entity = 'a' AND x3 IS NOT NULL").agg(F.max(F.abs(F.col("y") - F.col("prediction")))).first()[0]
    assert error < 1
    assert scored.where("(entity = 'few' OR x3 IS NULL) AND prediction IS NOT NULL").count() == 0
    with pytest.raises(ValueError):
        PE.fit_per_entity(df, ["y"], "y")
    assert PE.fit_per_entity(df.where("false"), names, "y").count() == 0


def test_repeated_features_share_the_weight(spark):
    df = spark.range(20).select(F.lit("e").alias("entity"), F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("b"), (F.col("id") * 3.0).alias("y"))
    r = PE.fit_per_entity(df, ["a", "b"], "y").first()
    assert r["weights"][0] + 2 * r["weights"][1] == pytest.approx(3.0) and r["intercept"] == pytest.approx(0.0, abs=1e-9)


def test_manifest_of_files_of_any_size(spark, tmp_path):
    """A sparse file beyond 2 GiB, names with blanks and percent signs; files without content are passed over."""
    big = tmp_path / "big file.bin"
    with open(big, "wb") as f:
        f.truncate(2_250_000_000)
    (tmp_path / "a%20b.txt").write_bytes(b"text")
    (tmp_path / "empty").write_bytes(b"")
    want = {}
    for p in (p for p in tmp_path.iterdir() if p.stat().st_size):
        digest = hashlib.sha256()
        with open(p, "rb") as f:
            while chunk := f.read(8 << 20):
                digest.update(chunk)
        want[p.name] = (digest.hexdigest(), p.stat().st_size)
    got = MF.build_manifest(spark, [str(tmp_path), str(tmp_path / "absent")], "here").collect()
    assert {r["path"].rsplit("/", 1)[1]: (r["hash"], r["size_bytes"]) for r in got} == want
    assert {r["source"] for r in got} == {"here"} and all(r["last_modified"] for r in got)


def test_hot_folders_are_written_by_several_tasks(spark, tmp_path):
    """A third of the rows in one entity; small entities share a task."""
    df = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("e"), F.col("id") % 40)).alias("entity"),
        F.col("id").cast("int").alias("period"), F.rand(1).alias("x"))
    for key, value in (("spark.sql.adaptive.advisoryPartitionSizeInBytes", "400k"), ("spark.sql.shuffle.partitions", "64")):
        spark.conf.set(key, value)
    try:
        PN.write_panel(df, str(tmp_path / "p"), partition_by=["entity"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    files = {d.name: len(list(d.glob("part-*"))) for d in (tmp_path / "p").iterdir() if d.is_dir()}
    assert files["entity=hot"] > 2 and sum(n for d, n in files.items() if d != "entity=hot") < 2 * 40
    assert spark.read.parquet(str(tmp_path / "p")).count() == 300_000


def test_scratch_folder_of_a_plain_session(tmp_path):
    """No configuration folder, no setting: tables go below the warehouse; a key of the session names another place."""
    code = """
import sys
from pyspark.sql import SparkSession
from panelwright.session import materialize, shared_dir
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
assert shared_dir(spark).endswith("spark-warehouse/_scratch"), shared_dir(spark)
assert materialize(spark.range(5), "t").count() == 5
spark.conf.set("panelwright.scratch.dir", sys.argv[1])
assert shared_dir(spark) == sys.argv[1] and materialize(spark.range(3), "t").count() == 3
print("fine")
"""
    (tmp_path / "conf").mkdir()
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path / "conf"), "PYTHONPATH": str(Path(__file__).resolve().parent.parent)}
    env.pop("SPARK_REMOTE", None)
    out = subprocess.run([sys.executable, "-c", code, str(tmp_path / "mine")], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200)
    assert "fine" in out.stdout, out.stderr[-2000:]
    assert (tmp_path / "mine").is_dir()
