"""The fold schedule with its training-only augmentation, chosen rounds, and the booster
on raw categories."""
import hashlib

import pytest
from pyspark.ml import Estimator, Model
from pyspark.sql import functions as F

from sextant.functions.hashing import uniform
from sextant.operators import crossfit as X
from sextant.operators.ordered_stats import (CategoryBooster, apply_statistics, ordered_target_statistics,
                                             target_statistics)

FEATURES = ["x", "z"]


def rows_frame(spark, n=240):
    df = spark.range(n).select("id", (F.col("id") % 12).alias("grp"), uniform("id", seed=1).alias("x"), uniform("id", seed=2).alias("z"))
    return df.withColumn("y", (F.col("x") + F.lit(0.2) * F.col("z") > 0.6).cast("int"))


class Recorded(Estimator):
    """Keeps the rows it was fitted and applied on."""

    def __init__(self, log, seed):
        super().__init__()
        self.log, self.seed = log, seed

    def _fit(self, df):
        self.log[self.seed] = {"fit": df.collect(), "cols": df.columns, "scored": []}
        return Echo(self.log[self.seed])


class Echo(Model):
    def __init__(self, entry):
        super().__init__()
        self.entry = entry

    def _transform(self, df):
        self.entry["scored"].append([r.asDict() for r in df.collect()])
        return df.withColumn("prob", F.col("x"))


@pytest.mark.parametrize("swap", [False, True])
def test_augmentation_never_meets_a_row_that_is_scored(spark, swap):
    df = rows_frame(spark)
    te = df.where("id % 5 = 0").drop("y")
    tr = df.where("id % 5 > 0").withColumn("y", F.when(F.col("id") != 7, F.col("y")))     # one without a label
    original = {r.id: (r.x, r.z) for r in df.collect()}
    aug = [X.MixUp(inputCols=FEATURES, labelCol="y", noiseStd=0.05)] if not swap else [
        X.GroupSwap(inputCols=FEATURES, labelCol="y", groupCol="grp", fraction=0.9)]
    log, seen = {}, []

    class Spy(type(aug[0])):
        def _transform(self, rows):
            out = super()._transform(rows)
            seen.append({(r.id, r.partner) for r in out.select("id", "partner").collect()})
            return out
    spy = Spy(**{p.name: v for p, v in aug[0].extractParamMap().items()})
    fit = X.training(lambda s: Recorded(log, s), "id", "y", FEATURES, [spy])
    preds = X.cross_fit(tr, "id", "y", "m", fit, te, seeds=[3, 4], folds=3, runs=2, parallelism=1).collect()
    assert len(log) == len(seen) == 2 * 2 * 3
    for entry, pairs in zip(log.values(), seen):
        oof, applied = ({r["id"] for r in part} for part in entry["scored"])
        held = {r.id for r in entry["fit"] if r.held}
        used = {i for pair in pairs for i in pair} | {r.id for r in entry["fit"]}
        assert not used & oof and not used & applied and 7 not in used
        assert held and not held & {i for pair in pairs for i in pair}
        assert any(a != b for a, b in pairs)
        for part in entry["scored"]:
            assert all((r["x"], r["z"]) == original[r["id"]] for r in part)
        for r in entry["fit"]:
            assert not r.held or (r.x, r.z) == original[r.id]
        moved = [r for r in entry["fit"] if not r.held and (r.x, r.z) != original[r.id]]
        assert len(entry["fit"]) == 2 * len(used - held) + len(held) and len(moved) > len(used) / 4
    labelled = sorted(i for i in original if i % 5 and i != 7)
    for run in (0, 1):
        for seed in (3, 4):
            mine = [p for p in preds if p.run == run and p.seed == seed]
            assert sorted(p.id for p in mine if p.kind == "oof") == labelled
            assert sum(p.kind == "apply" for p in mine) == 3 * te.count()
    # folds are balanced by label and differ between runs
    y = {r.id: r.y for r in tr.collect()}
    folds = {run: {p.id: p.fold for p in preds if p.run == run and p.seed == 3 and p.kind == "oof"} for run in (0, 1)}
    assert folds[0] != folds[1]
    for cls in (0, 1):
        size = [sum(f == k and y[i] == cls for i, f in folds[0].items()) for k in range(3)]
        assert max(size) - min(size) <= 1


def test_average_of_runs(spark):
    rows = [(1, "m", 0, 1, 0, 0.2, "oof"), (1, "m", 0, 2, 0, 0.4, "oof"), (1, "m", 1, 1, 0, 0.9, "oof"),
            (2, "m", 0, 1, 0, 0.1, "apply"), (2, "m", 0, 1, 1, 0.3, "apply"), (2, "m", 1, 1, 0, 0.6, "apply"), (2, "m", 1, 1, 1, None, "apply")]
    df = spark.createDataFrame(rows, "id long, model string, run int, seed int, fold int, prob double, kind string")
    got = {(r.id, r.kind): (round(r.prob, 9), r.n_preds) for r in X.average_runs(df, "id").collect()}
    assert got == {(1, "oof"): (0.6, 3), (2, "apply"): (0.4, 3)}


def test_rounds_are_chosen_by_the_held_out_loss(spark):
    noisy = rows_frame(spark, 1500).withColumn("y", F.when(uniform("id", seed=9) < 0.25, 1 - F.col("y")).otherwise(F.col("y")))
    rows = X.training_rows(noisy, "id", "y", FEATURES, 5).persist()
    model = X.Booster(FEATURES, 5, "y", tol=1e-3, maxIter=80, maxDepth=3, stepSize=0.3).fit(rows)
    assert 1 < model.rounds < 80
    est = X.gbt(5, maxIter=model.rounds + 1, maxDepth=3, stepSize=0.3).setLabelCol("_label")
    both = X.assemble(rows, FEATURES).withColumn("_label", F.col("y").cast("double"))
    loss = est.fit(both.where("not held")).evaluateEachIteration(both.where("held"))
    gains = [(a - b) / max(b, 0.01) for a, b in zip(loss, loss[1:])]
    assert gains[model.rounds - 1] < 1e-3 <= min(gains[:model.rounds - 1])
    none = rows.withColumn("held", F.lit(False))
    assert X.Booster(FEATURES, 5, "y", maxIter=4, maxDepth=2).fit(none).rounds == 4


def test_perceptron_resumes_and_stops(spark):
    rows = X.training_rows(rows_frame(spark, 400), "id", "y", FEATURES, 5).coalesce(1).persist()
    steps = []
    fit = X.MultilayerPerceptronClassifier.fit

    def spy(self, df):
        steps.append((self.getMaxIter(), self.getInitialWeights() if self.isSet(self.initialWeights) else None))
        model = fit(self, df)
        steps[-1] += (model.weights,)
        return model
    X.MultilayerPerceptronClassifier.fit, kept = spy, X.MultilayerPerceptronClassifier.fit
    try:
        model = X.Perceptron(FEATURES, 1, "y", hidden=(6, 4), max_iter=35, step=10, patience=9).fit(rows)
    finally:
        X.MultilayerPerceptronClassifier.fit = kept
    assert [s[0] for s in steps] == [10, 10, 10, 5] and steps[0][1] is None
    for a, b in zip(steps, steps[1:]):
        assert list(b[1]) == list(a[2])                      # the weights so far
    out = model.transform(rows.where("held"))
    assert out.agg(F.avg(((F.col("prob") >= 0.5) == (F.col("y") == 1)).cast("double"))).first()[0] > 0.8
    assert model.rounds in (10, 20, 30, 35)


def plain_statistics(rows, col, weight, seed):
    def h(i):
        return int(hashlib.md5(f"{i}:{seed}:order".encode()).hexdigest()[:8], 16)
    known = [r["y"] for r in rows if r["y"] is not None]
    prior = sum(known) / len(known)
    out, tally = {}, {}
    for r in sorted(rows, key=lambda r: (h(r["id"]), r["id"])):
        s, n = tally.get(r[col], (0, 0))
        out[r["id"]] = (s + weight * prior) / (n + weight)
        if r["y"] is not None:
            tally[r[col]] = (s + r["y"], n + 1)
    return out


@pytest.mark.parametrize("n_chunks", [None, 1, 7, 5000])
def test_ordered_statistics_match_a_plain_prefix(spark, n_chunks):
    rows = [{"id": i, "a": ["hot", "hot", "b", None, "c"][i % 5], "b": i % 40, "y": None if i % 11 == 3 else i * i % 7 % 2}
            for i in range(400)]
    df = spark.createDataFrame([(r["id"], r["a"], r["b"], r["y"], "extra") for r in rows], "id long, a string, b int, y int, n string")
    got = {r.id: (r.os_a, r.os_b) for r in ordered_target_statistics(df, "id", ["a", "b"], "y", 8, 2.0, n_chunks).collect()}
    a, b = (plain_statistics(rows, c, 2.0, 8) for c in "ab")
    assert set(got) == set(a)
    assert all(abs(got[i][0] - a[i]) < 1e-12 and abs(got[i][1] - b[i]) < 1e-12 for i in got)
    assert ordered_target_statistics(df.where("id < 0"), "id", ["a"], "y").count() == 0
    blind = ordered_target_statistics(df.withColumn("y", F.lit(None).cast("int")), "id", ["a"], "y")
    assert blind.where("os_a is not null").count() == 0 and blind.count() == 400


def test_hot_value_is_spread_over_ranges(spark):
    df = spark.range(3000).select("id", F.lit("one").alias("a"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    out = ordered_target_statistics(df, "id", ["a"], "y", n_chunks=64)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(_c" in plan.replace(" ", "") and "_k#" in plan
    assert out.agg(F.max(F.abs(F.col("os_a") - 1 / 3))).first()[0] < 0.7 and out.count() == 3000


def test_scoring_takes_the_statistics_of_all_training_rows(spark):
    df = spark.createDataFrame([(1, "u", 1), (2, "u", 0), (3, "v", 1), (4, None, 0), (5, "w", None)], "id long, a string, y int")
    table = target_statistics(df, ["a"], "y")
    new = spark.createDataFrame([("u",), ("v",), (None,), ("w",), ("zz",)], "a string")
    got = [round(r.os_a, 9) for r in apply_statistics(new, table, ["a"], 0.5).collect()]
    assert got == [0.5, 0.75, 0.25, 0.5, 0.5]


def test_category_booster_learns_categories_but_not_single_rows(spark):
    df = spark.range(900).select("id", (F.col("id") % 6).cast("string").alias("good"), F.col("id").cast("string").alias("key"),
                                 uniform("id", seed=3).alias("x"))
    df = df.withColumn("y", (F.col("good").cast("int") % 2 == 0).cast("int"))
    coin = df.withColumn("y", (uniform("id", seed=4) < 0.5).cast("int"))

    def accuracy(frame, cats):
        fit = X.training(lambda s: CategoryBooster("id", cats, ["x"], s, "y", maxIter=10, maxDepth=3), "id", "y", ["x"], keep=cats)
        p = X.cross_fit(frame, "id", "y", "cat", fit, seeds=[1], folds=2, parallelism=2)
        return p.join(frame, "id").agg(F.avg(((F.col("prob") >= 0.5) == (F.col("y") == 1)).cast("double"))).first()[0]
    assert accuracy(df, ["good"]) > 0.95
    assert accuracy(coin, ["key"]) < 0.6
