"""Model-loop mechanics on small fixtures: self-training rounds and the
calibration gate."""
import hashlib

from pyspark.sql import functions as F

from sextant.functions.hashing import uniform
from sextant.operators import models
from sextant.session import fit_tasks


def test_pseudo_label_rounds_add_confident_rows_once(spark):
    base = spark.range(400).select("id", (F.col("id") % 10).cast("double").alias("x"),
                                   uniform("id", seed=5).alias("noise"))
    base = base.withColumn("y", (F.col("x") >= 5).cast("int"))
    train, test = base.where("id % 2 = 0"), base.where("id % 2 = 1").drop("y")
    hist = models.pseudo_label_rounds(train, test, "id", "y", ["x", "noise"], hi=0.9, rounds=2, k=3)
    rows = {r["round"]: r for r in hist.collect()}
    assert rows[0]["n_added"] == 0 and 1 in rows
    assert all(0 < r["n_added"] <= 200 for k, r in rows.items() if k > 0)   # each test row at most once
    for k, r in rows.items():
        if k > 0:
            assert r["accepted"] == int(r["accuracy"] > r["best_before"])


def test_calibration_gate_only_when_better(spark):
    df = spark.range(2000).select("id", uniform("id", seed=1).alias("p"))
    df = df.withColumn("y", (uniform("id", seed=2) < F.col("p") * F.col("p")).cast("int"))
    out = models.calibrate_if_better(df, "id", "p", "y", df.select("id", "p"), 4, 42)
    flags = {r["calibrated"] for r in out.select("calibrated").distinct().collect()}
    assert len(flags) == 1
    assert out.where("prob_used < 0 OR prob_used > 1").count() == 0
    if flags == {0}:
        assert out.where("prob_used <> p").count() == 0 if "p" in out.columns else True


def test_permutation_importance_matches_brute_force(spark, monkeypatch):
    fitted, fit = [], models.RandomForestClassifier.fit
    monkeypatch.setattr(models.RandomForestClassifier, "fit",
                        lambda self, df: fitted.append(fit(self, df)) or fitted[-1])
    df = spark.range(300).select("id", (F.col("id") % 10).cast("double").alias("x"), uniform("id", seed=5).alias("noise"))
    df = df.withColumn("x", F.when(F.col("id") % 50 != 7, F.col("x")))        # some NULLs
    df = df.withColumn("y", (F.col("id") % 10 >= 5).cast("int"))
    rows = sorted(df.collect(), key=lambda r: (int(hashlib.md5(f"{r.id}:42:perm".encode()).hexdigest()[:8], 16), r.id))

    def accuracy(name=None):
        test = [(r.id, r.y, *[(nxt if c == name else r)[c] for c in ("x", "noise")])
                for r, nxt in zip(rows, rows[1:] + rows[:1])]
        frame = models.assemble(spark.createDataFrame(test, "id long, y int, x double, noise double"), ["x", "noise"])
        p = fitted[0].transform(frame).select("y", models.positive_prob().alias("p")).collect()
        return sum((r.p >= 0.5) == (r.y == 1) for r in p) / len(p)
    for n_ranges in (1, 16, 1024):
        got = {r.feature: r for r in
               models.permutation_importance(df, "id", "y", ["x", "noise"], n_ranges=n_ranges).collect()}
        assert set(got) == {"x", "noise"} and got["x"].importance > 0.3
        for c, r in got.items():
            assert abs(r.permuted_accuracy - accuracy(c)) < 1e-9 and abs(r.base_accuracy - accuracy()) < 1e-9


def test_permutation_importance_query(spark):
    from sextant.plans.model_queries import FEATURES, permutation_importance
    rows = permutation_importance(spark, "/root/testdata/sf0.001").collect()
    assert sorted(r.feature for r in rows) == sorted(FEATURES)


def test_fold_runner_fits_in_few_tasks_and_keeps_columns(spark, monkeypatch):
    seen, fit = [], models.RandomForestClassifier.fit
    monkeypatch.setattr(models.RandomForestClassifier, "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    df = spark.range(300).select("id", uniform("id", seed=1).alias("x"), uniform("id", seed=2).alias("z"))
    df = df.withColumn("y", (F.col("x") > 0.5).cast("int"))
    most = fit_tasks(spark, 300)
    tr, te = df.where("id % 3 > 0").repartition(4 * most), df.where("id % 3 = 0").repartition(3 * most)
    preds = models.fold_runner(tr, "id", "y", ["x", "z"], lambda s, f: models.forest(s, numTrees=3, maxDepth=3), "m", [42], 2, te, keep=["y", "x"])
    assert len(seen) == 2 and max(seen) <= most
    assert preds.rdd.getNumPartitions() <= 2 * 2 * most
    got = {(r.id, r.kind): r.y for r in preds.collect()}
    want = {(r.id, "oof" if r.id % 3 else "apply"): r.y if r.id % 3 else None for r in df.collect()}
    assert got == want
    assert fit_tasks(spark, 10**9) == 1000
