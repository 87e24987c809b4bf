"""Edge fixtures for statistics, encoders, group and evaluation operators
"""
import pytest
from pyspark.sql import functions as F

from sextant.operators import augment, encode, evaluate, folds, groups, impute, profile, stats


def test_group_mode_ties_and_all_null(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, None), (3, "z")], "g int, v string")
    keys = df.select("g").distinct()
    out = {r["g"]: r["m"] for r in keys.join(stats.mode_table(df, "g", "v", "m"), "g", "left").collect()}
    assert out == {1: "a", 2: None, 3: "z"}


def test_group_median_percentile(spark):
    df = spark.createDataFrame([(1, float(x)) for x in [1, 2, 4, 10]], "g int, x double")
    r = stats.percentile_table(df, "g", "x", [0.5, 0.1], {("x", 0.5): "m", ("x", 0.1): "p"}).first()
    assert r["m"] == pytest.approx(3.0) and r["p"] == pytest.approx(1.3)


def test_impute_group_mode_and_cascade(spark):
    df = spark.createDataFrame([(0, 1, "x", None), (1, 1, "x", "a"), (2, 2, None, None), (3, 2, "y", "b")],
                               "id int, g int, c string, d string")
    out = impute.impute_group_mode(df, "g", "c")
    assert {r["id"]: r["c"] for r in out.collect()} == {0: "x", 1: "x", 2: "y", 3: "y"}
    out = impute.impute_category_cascade(df, [("c", "d")], {"d": "mode"})
    assert {r["id"]: r["d"] for r in out.collect()} == {0: "a", 1: "a", 2: "a", 3: "b"}


def test_median_cascade_uses_unfilled_column(spark):
    df = spark.createDataFrame([(0, 1, "p", None), (1, 1, "p", 10.0), (2, 2, "p", None), (3, 3, "q", 1.0)],
                               "id int, g int, h string, x double")
    out = impute.impute_median_cascade(df, "x", ["g", "h"])
    assert {r["id"]: r["x"] for r in out.collect()} == {0: 10.0, 1: 10.0, 2: 10.0, 3: 1.0}


def test_impute_amounts_flag_zero(spark):
    df = spark.createDataFrame([(0, True, "p", None), (1, False, "p", None), (2, False, "p", 4.0), (3, None, "q", 2.0)],
                               "id int, f boolean, h string, a double")
    out = impute.impute_amounts(df, ["a"], "f", "h")
    assert {r["id"]: r["a"] for r in out.collect()} == {0: 0.0, 1: 2.0, 2: 4.0, 3: 2.0}


def test_loo_target_mean(spark):
    df = spark.createDataFrame([(0, 1, 1), (1, 2, 1), (2, 2, 0), (3, 2, 1)], "id int, k int, y int")
    out = {r["id"]: r["loo_mean"] for r in groups.loo_target_mean(df, "k", "y").collect()}
    assert out == {0: 0.0, 1: 0.5, 2: 1.0, 3: 0.5}


def test_target_encode_smoothing_and_unseen(spark):
    tr = spark.createDataFrame([(0, "a", 1), (1, "a", 0)], "id int, c string, y int")
    te = spark.createDataFrame([(9, "a"), (10, "zz")], "id int, c string")
    out = {r["id"]: r["te_c"] for r in encode.target_encode_full(tr, te, ["c"], "y", 10.0, prior=0.6).collect()}
    assert out[9] == pytest.approx(0.583333, abs=1e-6) and out[10] == pytest.approx(0.6)


def test_target_encode_oof_excludes_own_fold(spark):
    tr = spark.createDataFrame([(0, "a", 1, 0), (1, "a", 0, 1), (2, "a", 1, 1)], "id int, c string, y int, fold int")
    out = {r["id"]: r["te_c"] for r in encode.target_encode_oof(tr, ["c"], "y", "fold", 10.0, prior=0.5).collect()}
    assert out[0] == pytest.approx((1 + 5) / 12)   # other fold: rows 1, 2 -> sum 1, n 2
    assert out[1] == pytest.approx((1 + 5) / 11)   # other fold: row 0 -> sum 1, n 1


def test_ordinal_encode_code_point_order(spark):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, None)], "id int, c string")
    out = {r["id"]: r["c_code"] for r in encode.ordinal_encode(df, ["c"]).collect()}
    assert out == {0: 2, 1: 1, 2: 0}


def test_tfidf_terms(spark):
    df = spark.createDataFrame([(1, "red ring"), (2, "red bolt a")], "id int, text string")
    t = {(r["id"], r["term"]): (r["idf"], r["weight"]) for r in encode.tfidf_terms(df, "id", "text").collect()}
    assert (2, "a") not in t
    assert t[(1, "red")][0] == pytest.approx(1.0) and t[(1, "ring")][0] == pytest.approx(1.405465, abs=1e-6)
    assert t[(1, "red")][1] == pytest.approx(0.579739, abs=1e-6)
    assert t[(1, "ring")][1] == pytest.approx(0.814802, abs=1e-6)


def test_threshold_sweep_lowest_cut_wins(spark):
    df = spark.createDataFrame([(0.401, 0), (0.6, 1)], "p double, y int")
    b = evaluate.best_threshold(evaluate.threshold_sweep(df, "p", "y")).first()
    assert b["cut_index"] == 21 and b["threshold"] == pytest.approx(0.4025) and b["accuracy"] == 1.0


def test_threshold_sweep_matches_brute_force(spark):
    from sextant.functions.hashing import uniform
    df = spark.range(3000).select("id", uniform("id", seed=7).alias("p"),
                                  (uniform("id", seed=8) < 0.4).cast("int").alias("y"))
    sw = {r["cut_index"]: r["correct"] for r in evaluate.threshold_sweep(df, "p", "y").collect()}
    pdf = df.toPandas()
    for i in range(121):
        t = (3500 + 25 * i) / 10000
        assert sw[i] == int(((pdf.p >= t).astype(int) == pdf.y).sum())


@pytest.mark.parametrize("probs,expected", [
    ((.9, .8, .7), (.93, .86, .79)), ((.1, .2, .3), (.07, .14, .21)),
    ((.9, .1, .5), (.9, .1, .5)), ((.75, .75, .75), (.75, .75, .75)), ((1.0, 1.0, .3), (1.0, 1.0, .51))])
def test_group_consistency(spark, probs, expected):
    df = spark.createDataFrame([(i, 1, p, None) for i, p in enumerate(probs)], "id int, g int, p double, lock int")
    out = [r["prob_adj"] for r in groups.group_consistency(df, "g", "p", "lock").orderBy("id").collect()]
    assert out == pytest.approx(list(expected))


def test_group_consistency_pairs_and_locks(spark):
    df = spark.createDataFrame([(0, 1, .9, None), (1, 1, .9, None)], "id int, g int, p double, lock int")
    assert [r["prob_adj"] for r in groups.group_consistency(df, "g", "p", "lock").collect()] == [.9, .9]
    df = spark.createDataFrame([(0, 1, .9, 1), (1, 1, .8, None), (2, 1, .7, None)], "id int, g int, p double, lock int")
    out = [r["prob_adj"] for r in groups.group_consistency(df, "g", "p", "lock").orderBy("id").collect()]
    assert out == pytest.approx([.9, .86, .79])


def test_priority_merge_and_pseudo_select(spark):
    df = spark.createDataFrame([(0, 0, 1), (1, 1, None)], "id int, model int, lock int")
    assert [r[0] for r in df.orderBy("id").select(F.coalesce("lock", "model")).collect()] == [1, 1]
    df = spark.createDataFrame([(0, .92), (1, .91), (2, .07), (3, .5)], "id int, p double")
    sel = df.where((F.col("p") >= .92) | (F.col("p") <= 1 - .92))
    assert sorted(r["id"] for r in sel.collect()) == [0, 2]


def test_mixup_pair_values(spark):
    df = spark.createDataFrame([(0, 1.0, 10.0, 1), (1, 3.0, 20.0, 0)], "id int, a double, b double, y int")
    m = augment.mixup_pairs(df, "id", ["a", "b"], "y", 0.7, seed=1, n_ranges=1)
    rows = {r["id"]: r for r in m.collect()}
    first = rows[0]
    assert first["partner"] == 1 and first["a"] == pytest.approx(1.6) and first["b"] == pytest.approx(13.0)
    assert first["y"] == 1


def test_correlation_pairwise_complete(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 5.0), (None, 9.0), (4.0, 4.0)], "x double, y double")
    c = {(r["col_a"], r["col_b"]): r["corr"] for r in profile.correlation_matrix(df, ["x", "y"]).collect()}
    assert c[("y", "x")] == pytest.approx(0.785714, abs=1e-6)


def test_roc_auc_ties(spark):
    df = spark.createDataFrame([(.1, 0), (.4, 1), (.4, 0), (.8, 1)], "p double, y int")
    assert evaluate.roc_auc(df, "p", "y").first()["auc"] == pytest.approx(0.875)


def test_running_best_chunked_equals_plain(spark):
    df = spark.createDataFrame([(i, i % 3, i // 4, float((i * 7) % 11)) for i in range(40)],
                               "t int, k int, day int, v double")
    a = {r["t"]: r["running_best"] for r in profile.running_best(df, "k", ["t"], "v").collect()}
    b = {r["t"]: r["running_best"] for r in profile.running_best(df, "k", ["t"], "v", chunk_col="day").collect()}
    assert a == b


# -- invariants ----------------------------------------------------------------

def test_folds_partition_invariant(spark):
    base = spark.range(2000).withColumn("y", (F.col("id") % 3 == 0).cast("int"))
    res = []
    for n in (1, 4, 16):
        f = folds.stratified_folds(base.repartition(n), "id", 5, 42)
        res.append(sorted((r["id"], r["fold"]) for r in f.collect()))
    assert res[0] == res[1] == res[2]
    share = base.transform(lambda d: folds.stratified_folds(d, "id", 5, 42)).groupBy("fold").agg(
        F.avg("y").alias("r")).collect()
    assert all(abs(r["r"] - 1 / 3) < 0.06 for r in share)


def test_repeated_folds_and_oof_average(spark):
    base = spark.range(100)
    rf = folds.repeated_folds(base, "id", [42, 7], 5)
    assert rf.count() == 200
    one = folds.stratified_folds(base, "id", 5, 42).select("id", F.col("fold").alias("f42"))
    joined = rf.where("seed = 42").join(one, "id")
    assert joined.where("fold <> f42").count() == 0
    preds = rf.withColumn("model", F.lit("m")).withColumn("prob", F.col("fold") / 10.0)
    avg = folds.oof_average(preds, ["id", "model"])
    assert avg.where("n_preds <> 2").count() == 0


def test_standard_scale_moments(spark):
    df = spark.range(50).select((F.col("id") * 3.0 + 1).alias("x"), F.lit(2.0).alias("c"))
    s = encode.standard_scale(df, ["x", "c"]).agg(F.avg("x"), F.stddev_pop("x"), F.max(F.abs("c"))).first()
    assert s[0] == pytest.approx(0, abs=1e-12) and s[1] == pytest.approx(1.0) and s[2] == 0


def test_mixup_augment_row_count(spark):
    df = spark.range(200).select("id", (F.col("id") % 2).cast("int").alias("y"), (F.col("id") * 1.0).alias("x"))
    out = augment.mixup_augment(df, "id", ["x"], "y", multiplier=2, n_ranges=4)
    assert out.count() == 600 and out.select("aug_key").distinct().count() == 600


def test_group_swap_same_group(spark):
    df = spark.range(60).select("id", (F.col("id") % 7).alias("g"), (F.col("id") * 1.0).alias("x"), F.lit(1).alias("y"))
    out = augment.group_swap(df, "id", "g", ["x"], "y", fraction=1.0)
    assert out.where("copy = 0").count() == 60 and out.where("copy = 0 and partner <> id").count() == 0
    out = out.where("copy = 1")
    assert out.where("partner = id").count() == 0
    part = out.join(df.select(F.col("id").alias("partner"), F.col("g").alias("pg")), "partner")
    assert part.where("g <> pg").count() == 0
    assert out.where("x <> CAST(partner AS DOUBLE)").count() == 0


def test_isotonic_monotone(spark):
    from sextant.operators import models
    from sextant.functions.hashing import uniform
    df = spark.range(600).select("id", uniform("id", seed=3).alias("p"))
    df = df.withColumn("y", (uniform("id", seed=4) < F.col("p")).cast("int"))
    cal = models.isotonic_calibration(df, "id", "p", "y", 3, 42, apply_to=df.select("id", "p"))
    ap = cal.where("kind = 'apply'").join(df, "id").orderBy("p").select("cal_prob").collect()
    vals = [r[0] for r in ap]
    assert all(a <= b + 1e-12 for a, b in zip(vals, vals[1:]))
    assert all(0 <= v <= 1 for v in vals)


def test_loo_missing_key_takes_prior(spark):
    df = spark.createDataFrame([(0, None, 1), (1, 2, 1), (2, 2, 0)], "id int, k int, y int")
    out = {r["id"]: r["loo_mean"] for r in groups.loo_target_mean(df, "k", "y", prior=0.25).collect()}
    assert out == {0: 0.25, 1: 0.0, 2: 1.0}


def test_text_svd_equals_numpy(spark):
    import numpy as np
    texts = ["red ring bolt", "red red ring", "blue bolt nut", "nut nut blue red", "green", "ring bolt nut blue",
             "a b", "red blue green ring"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    svd = {r["id"]: [r[f"svd_{j}"] for j in range(3)] for r in encode.text_svd(df, "id", "text", 3).collect()}
    terms = encode.tfidf_terms(df, "id", "text").collect()
    vocab = sorted({r["term"] for r in terms})
    a = np.zeros((len(texts), len(vocab)))
    for r in terms:
        a[r["id"], vocab.index(r["term"])] = r["weight"]
    u, s, vt = np.linalg.svd(a, full_matrices=False)
    want = u[:, :3] * s[:3]
    for j in range(3):
        col = np.array([svd[i][j] for i in range(len(texts))])
        assert np.allclose(np.abs(col), np.abs(want[:, j]), atol=1e-8)
    assert svd[6] == [0.0, 0.0, 0.0]          # no token of >= 2 characters


def test_exact_stratified_folds_balanced(spark):
    base = spark.range(1003).select("id", F.when(F.col("id") % 11 == 0, F.lit(None))
                                    .otherwise((F.col("id") % 3 == 0).cast("int")).alias("y"))
    a = folds.exact_stratified_folds(base, "id", "y", 5, 42, n_chunks=7)
    b = folds.exact_stratified_folds(base.repartition(13), "id", "y", 5, 42, n_chunks=64)
    assert sorted(map(tuple, a.select("id", "fold").collect())) == sorted(map(tuple, b.select("id", "fold").collect()))
    counts = a.groupBy("y", "fold").count().collect()
    per = {}
    for r in counts:
        per.setdefault(r["y"], []).append(r["count"])
    for y, cs in per.items():
        assert len(cs) == 5 and max(cs) - min(cs) <= 1, (y, cs)


def test_oof_encoding_leak_only_through_prior(spark):
    from sextant.functions.hashing import uniform
    base = spark.range(300).select("id", (F.col("id") % 4).cast("string").alias("c"),
                                   (uniform("id", seed=9) < 0.4).cast("int").alias("y"))
    base = folds.stratified_folds(base, "id", 5, 42)
    flipped = base.withColumn("y", F.when(F.col("id") == 17, 1 - F.col("y")).otherwise(F.col("y")))
    a = {r["id"]: r["te_c"] for r in encode.target_encode_oof(base, ["c"], "y", "fold", 10.0, prior=0.4).collect()}
    b = {r["id"]: r["te_c"] for r in encode.target_encode_oof(flipped, ["c"], "y", "fold", 10.0, prior=0.4).collect()}
    assert a[17] == pytest.approx(b[17])          # with a fixed prior the row's own label has no effect


def test_fold_runner_one_oof_prediction_per_seed(spark):
    from sextant.operators import models
    df = spark.range(300).select("id", (F.col("id") % 7).cast("double").alias("x"),
                                 (F.col("id") % 2).cast("int").alias("y"))
    preds = models.fold_runner(df, "id", "y", ["x"], lambda s, f: models.logistic(300), "lr", [42, 7], 3,
                               apply_to=df.limit(10).select("id", "x"))
    oof = preds.where("kind = 'oof'").groupBy("id").agg(F.count("*").alias("n"), F.countDistinct("seed").alias("s"))
    assert oof.count() == 300 and oof.where("n <> 2 OR s <> 2").count() == 0
    assert preds.where("prob < 0 OR prob > 1").count() == 0
    assert preds.where("kind = 'apply'").count() == 10 * 2 * 3


def test_ordinal_codes_shared_prefix_and_partitioning(spark):
    vals = [f"Brand#{i:05d}" for i in range(500)] + ["Apple", None, "zeta"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, c string")
    want = {v: i for i, v in enumerate(sorted({(v if v is not None else "__MISSING__") for v in vals}))}
    for n in (1, 7, 32):
        got = {r["value"]: r["code"] for r in encode.ordinal_codes(df.repartition(5), "c", n_buckets=n).collect()}
        assert got == want


def test_degenerate_inputs_give_null_not_errors(spark):
    one_class = spark.createDataFrame([(0.2, 1), (0.7, 1)], "p double, y int")
    assert evaluate.roc_auc(one_class, "p", "y").first()["auc"] is None
    empty = spark.createDataFrame([], "p double, y int")
    sw = evaluate.threshold_sweep(empty, "p", "y")
    assert sw.count() == 121 and sw.where("accuracy IS NOT NULL").count() == 0


def test_partners_do_not_depend_on_the_ranges(spark):
    df = spark.range(300).select("id", F.when(F.col("id") % 5 > 0, F.col("id") % 2).alias("g"),
                                 (F.col("id") * 1.0).alias("x"), (F.col("id") % 2).cast("int").alias("y"))
    pairs = [sorted(map(tuple, augment.mixup_pairs(df, "id", ["x"], "y", 0.3, n_ranges=n).collect())) for n in (1, 7, 1024)]
    assert pairs[0] == pairs[1] == pairs[2]
    assert len({p[1] for p in pairs[0]}) == 300         # every row is a partner once
    key = lambda t: tuple((v is not None, v) for v in t)
    swaps = [sorted(map(tuple, augment.group_swap(df, "id", "g", ["x"], "y", n_ranges=n).collect()), key=key)
             for n in (1, 64)]
    assert swaps[0] == swaps[1]


def test_missing_scores_count_as_below_the_cut(spark):
    df = spark.createDataFrame([(0.9, 1), (None, 0), (None, 1), (0.2, 0)], "p double, y int")
    assert df.agg(evaluate.accuracy_at("p", "y")).first()[0] == pytest.approx(0.75)
    at_half = evaluate.threshold_sweep(df, "p", "y").where("threshold = 0.5").first()
    assert at_half["accuracy"] == pytest.approx(0.75)
    assert evaluate.roc_auc(df, "p", "y").first()["n_missing"] == 2
    assert evaluate.roc_auc(df, "p", "y").first()["auc"] == pytest.approx(1.0)


def test_auc_of_scores_in_a_narrow_range(spark):
    df = spark.range(20000).select((F.lit(0.9999) + F.col("id") * 1e-9).alias("p"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    got = evaluate.roc_auc(df, "p", "y").first()["auc"]
    pdf = df.toPandas()
    r = pdf["p"].rank()
    n1, n0 = pdf["y"].sum(), (1 - pdf["y"]).sum()
    assert got == pytest.approx((r[pdf["y"] == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0))


def test_probability_histograms_edges_and_missing(spark):
    rows = [(0.0, 1.0), (0.24, -0.5), (0.25, 1.5), (1.0, None), (None, float("nan"))]
    df = spark.createDataFrame(rows, "a double, b double")
    got = {(r["model"], r["bin"]): r["n"] for r in evaluate.probability_histograms(df, {"A": "a", "B": "b"}, bins=4).collect()}
    assert got == {("A", 0): 2, ("A", 1): 1, ("A", 3): 1, ("B", 0): 1, ("B", 3): 2}
    assert evaluate.probability_histograms(df.where("false"), {"A": "a"}).count() == 0


def test_distinct_sorted(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("b",), ("C",)], "v string").repartition(4)
    assert [r.value for r in profile.distinct_sorted(df, "v").collect()] == ["C", "a", "b"]
    assert profile.distinct_sorted(df.limit(0), "v").count() == 0
