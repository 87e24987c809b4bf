"""Rows of the cross-validated fits: dealt over all tasks, folds kept as columns,
few fits at once over many rows."""
import threading

from pyspark.sql import functions as F

from sextant import session
from sextant.functions.hashing import uniform
from sextant.operators import models
from sextant.operators.evaluate import accuracy_at


def _frame(spark, n=600):
    df = spark.range(n).select("id", uniform("id", seed=1).alias("x"), uniform("id", seed=2).alias("z"))
    return df.withColumn("y", (F.col("x") + 0.3 * F.col("z") > 0.6).cast("int"))


def _forest(s, f):
    return models.forest(s, numTrees=3, maxDepth=3)


def test_fit_rows_from_two_partitions_reach_every_task(spark, monkeypatch):
    seen, fit = [], models.RandomForestClassifier.fit

    def spy(self, df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        sizes = df.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
        seen.append((sizes, [line for line in plan.splitlines() if "Filter" in line and "md5" in line]))
        return fit(self, df)
    monkeypatch.setattr(models.RandomForestClassifier, "fit", spy)
    df = _frame(spark)
    rows = df.repartition(16, (F.col("id") % 2))          # as after a join on two values
    preds = models.fold_runner(rows, "id", "y", ["x", "z"], _forest, "m", [42], 3, rows.select("id", "x", "z"))
    assert len(seen) == 3
    for sizes, hashed in seen:
        assert min(sizes) > 0 and max(sizes) < 3 * sum(sizes) / len(sizes) and not hashed
    sizes = preds.where("kind = 'apply'").rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
    assert sum(s > 0 for s in sizes) >= 3 * spark.sparkContext.defaultParallelism
    assert sum(sizes) == 3 * 600


def test_fits_repeat_whatever_the_order_of_rows(spark):
    df = _frame(spark)

    def run(d):
        spark.catalog.clearCache()
        p = models.fold_runner(d, "id", "y", ["x", "z"], _forest, "m", [42, 7], 3, keep=["y"])
        return {(r.id, r.seed, r.fold): (r.prob, r.y) for r in p.collect()}
    one = run(df.repartition(5, "x"))
    assert len(one) == 2 * 600 and one == run(df.orderBy(F.desc("z")).coalesce(1))


def test_fits_at_once_falls_with_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    assert session.fits_at_once(spark, 0, 6) == session.fits_at_once(spark, 1000, 6) == 6
    assert session.fits_at_once(spark, cores * 100_000, 6) == 2
    assert session.fits_at_once(spark, 10 ** 9, 6) == session.fits_at_once(spark, 10 ** 9, 0) == 1


def test_random_search_scores_as_the_fold_runner_and_bounds_fits(spark, monkeypatch):
    df, running, most, lock = _frame(spark), [0], [0], threading.Lock()
    fit = models.RandomForestClassifier.fit

    def spy(self, d):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        try:
            return fit(self, d)
        finally:
            with lock:
                running[0] -= 1
    monkeypatch.setattr(models.RandomForestClassifier, "fit", spy)
    monkeypatch.setattr(models, "fits_at_once", lambda spark, rows, wanted: 1, raising=False)
    got = models.random_search(df, "id", "y", ["x", "z"], {"numTrees": (2, 5), "maxDepth": (2, 4)}, 3, 3, 42).collect()
    assert [r.trial for r in got] == [0, 1, 2] and most[0] == 1
    for r in got:
        kw = dict(eval(r.params))
        p = models.fold_runner(df, "id", "y", ["x", "z"], lambda s, f, kw=kw: models.forest(s, **kw), "m", [42], 3, keep=["y"])
        assert abs(p.agg(accuracy_at("prob", "y", 0.5)).first()[0] - r.accuracy) < 1e-12
