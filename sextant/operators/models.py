"""Cross-validated Spark ML models and the steps around them.

The fold loop runs on the driver but every fit is a distributed Spark ML job;
predictions are kept as one long table (id, model, seed, fold, prob, kind), so
averaging over seeds / folds / runs is a grouped aggregate. Fits of
independent folds are submitted from a small thread pool (as
``CrossValidator(parallelism=...)`` does)."""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.classification import (GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash32
from ..session import cut_lineage, deal_rows, fit_tasks, fits_at_once
from .augment import _partner
from .evaluate import accuracy_at, best_threshold, roc_auc, threshold_sweep
from .folds import fold_of
from .isotonic import calibration_curves, mean_value, own_fold_value


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """Features as one vector column; NULL feature values become 0."""
    filled = df.fillna(0.0, list(features))
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(filled)


def positive_prob(col: str = "probability"):
    return vector_to_array(F.col(col)).getItem(1)


def gbt(seed: int, **kw):
    # node statistics for more nodes per pass (fewer passes over the data) and
    # cached node ids; neither changes the fitted trees. A forest does without the
    # ids: they are one number per row and tree, held twice
    params = dict(maxDepth=5, maxIter=20, stepSize=0.1, minInstancesPerNode=10, maxBins=64,
                  maxMemoryInMB=1024, cacheNodeIds=True)
    params.update(kw)
    return GBTClassifier(seed=seed, **params)


def forest(seed: int, **kw):
    params = dict(numTrees=40, maxDepth=8, minInstancesPerNode=2, maxBins=64,
                  maxMemoryInMB=1024, cacheNodeIds=False)
    params.update(kw)
    return RandomForestClassifier(seed=seed, **params)


def logistic(n_rows: int, C: float = 0.5, **kw):
    """L2 logistic regression with the inverse-strength parameter C
    (regParam = 1 / (C n), no feature standardisation)."""
    return LogisticRegression(regParam=1.0 / (C * max(n_rows, 1)), elasticNetParam=0.0,
                              standardization=False, maxIter=200, **kw)


def mlp(n_features: int, seed: int, hidden=(16, 8), max_iter: int = 50):
    return MultilayerPerceptronClassifier(layers=[n_features, *hidden, 2], seed=seed, maxIter=max_iter)


def fold_runner(train: DataFrame, id_col: str, label: str, features: Sequence[str],
                factory: Callable[[int, int], object], model_name: str,
                seeds: Sequence[int] = (42,), k: int = 3, apply_to: DataFrame | None = None,
                parallelism: int = 2, keep: Sequence[str] = ()) -> DataFrame:
    """``fold_runner_many`` for one model."""
    return fold_runner_many(train, id_col, label, features, {model_name: factory}, seeds, k, apply_to,
                            parallelism, keep)


def fold_runner_many(train: DataFrame, id_col: str, label: str, features: Sequence[str],
                     factories: dict[str, Callable[[int, int], object]],
                     seeds: Sequence[int] = (42,), k: int = 3, apply_to: DataFrame | None = None,
                     parallelism: int = 2, keep: Sequence[str] = ()) -> DataFrame:
    """Out-of-fold predictions of every model (name -> factory) for every (seed, fold) plus
    predictions on ``apply_to`` (the unlabelled rows) from each fold model.

    The rows are cached once for all fits, with their folds as columns (a fit reads them
    several times and would hash every key each time) and dealt evenly by key. Every pass
    of a fit runs in ``fit_tasks`` tasks, however many partitions ``train`` has, and at
    most ``fits_at_once`` of ``parallelism`` fits run side by side.
    Returns (id, model, seed, fold, prob, kind) with kind 'oof' or 'apply', and the
    columns ``keep`` of ``train`` (NULL for 'apply')."""
    spark = train.sparkSession
    kept = [c for c in keep if c not in features]
    tr = assemble(train.select(*dict.fromkeys([id_col, label, *kept, *features])), features)
    tr = tr.select(*dict.fromkeys([id_col, *kept]), "features", F.col(label).cast("double").alias("_label"),
                   *[fold_of(id_col, s, k).alias(f"_fold_{s}") for s in dict.fromkeys(seeds)])
    tr = deal_rows(tr, id_col).persist()
    ap = None
    if apply_to is not None:
        ap = assemble(apply_to.select(id_col, *features), features).select(id_col, "features")
        ap = deal_rows(ap, id_col).persist()
    n = tr.count()
    tasks = fit_tasks(spark, n)
    ap_tasks = fit_tasks(spark, ap.count()) if ap is not None else 0

    def one(job):
        name, seed, f = job
        fo = F.col(f"_fold_{seed}")
        est = factories[name](seed, f).setFeaturesCol("features").setLabelCol("_label")
        model = est.fit(tr.where(fo != f).coalesce(tasks))
        parts = [model.transform(tr.where(fo == f).coalesce(tasks)).select(
            id_col, positive_prob().alias("prob"), F.lit("oof").alias("kind"), *kept)]
        if ap is not None:
            parts.append(model.transform(ap.coalesce(ap_tasks)).select(
                id_col, positive_prob().alias("prob"), F.lit("apply").alias("kind"),
                *[F.lit(None).cast(tr.schema[c].dataType).alias(c) for c in kept]))
        out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return out.select(id_col, F.lit(name).alias("model"), F.lit(seed).alias("seed"),
                          F.lit(f).alias("fold"), "prob", "kind", *kept)

    jobs = [(name, s, f) for name in factories for s in seeds for f in range(k)]
    with ThreadPoolExecutor(max_workers=fits_at_once(spark, n, parallelism)) as pool:
        frames = list(pool.map(one, jobs))
    out = frames[0]
    for fr in frames[1:]:
        out = out.unionByName(fr)
    return out


def average_predictions(preds: DataFrame, id_col: str) -> DataFrame:
    """OOF rows: mean over seeds; apply rows: mean over all fold models."""
    return preds.groupBy(id_col, "model", "kind").agg(F.avg("prob").alias("prob"),
                                                      F.count(F.lit(1)).alias("n_preds"))


def fold_scores(preds: DataFrame, labels: DataFrame, id_col: str, label: str) -> DataFrame:
    """Accuracy at 0.5 per (seed, fold, model) for the OOF rows."""
    oof = preds.where(F.col("kind") == "oof").join(labels.select(id_col, label), id_col)
    return oof.groupBy("seed", "fold", "model").agg(accuracy_at("prob", label, 0.5).alias("accuracy"))


def stack_logistic(wide: DataFrame, id_col: str, label: str, inputs: Sequence[str],
                   C: float = 0.5, apply_to: DataFrame | None = None) -> DataFrame:
    """Logistic regression over per-model probabilities, scored on the rows it
    was fitted on (as the source does) and on ``apply_to``."""
    n = wide.count()
    tr = assemble(wide, inputs).withColumn("_label", F.col(label).cast("double"))
    model = logistic(n, C).setFeaturesCol("features").setLabelCol("_label").fit(tr)
    out = model.transform(tr).select(id_col, positive_prob().alias("stack_prob"), F.lit("oof").alias("kind"))
    if apply_to is not None:
        out = out.unionByName(model.transform(assemble(apply_to, inputs)).select(
            id_col, positive_prob().alias("stack_prob"), F.lit("apply").alias("kind")))
    return out


def isotonic_calibration(df: DataFrame, id_col: str, prob: str, label: str, k: int = 5,
                         seed: int = 42, apply_to: DataFrame | None = None) -> DataFrame:
    """Fold-wise isotonic calibration (``operators.isotonic``): each fold, stratified by
    label, is calibrated by the curve of the other folds; ``apply_to`` rows get the mean
    of the k curves. Scores outside a curve get its end values, NULL scores NULL."""
    rows, curves = calibration_curves(df, id_col, prob, label, k, seed)
    out = rows.select(id_col, F.lit("oof").alias("kind"),
                      own_fold_value(F.col("_x"), F.col("fold"), curves).alias("cal_prob"))
    if apply_to is not None:
        out = out.unionByName(apply_to.select(id_col, F.lit("apply").alias("kind"),
                                              mean_value(F.col(prob), curves).alias("cal_prob")))
    return out


def random_search(train: DataFrame, id_col: str, label: str, features: Sequence[str],
                  space: dict[str, tuple], n_trials: int = 4, k: int = 3, seed: int = 42,
                  parallelism: int = 2) -> DataFrame:
    """Seeded random search over forest settings; each trial's score is the
    k-fold OOF accuracy (one distributed fit per fold). All trials share one
    cached training frame; the fits of up to ``parallelism`` trials are
    submitted side by side (fewer if their rows fill the cores), and one job
    scores them all."""
    rng = random.Random(seed)
    trials = []
    for t in range(n_trials):
        params = {}
        for name, (lo, hi) in space.items():
            params[name] = rng.randint(lo, hi) if isinstance(lo, int) else rng.uniform(lo, hi)
        trials.append((t, params))
    preds = fold_runner_many(train, id_col, label, features,
                             {f"trial_{t}": lambda s, f, p=params: forest(s, **p) for t, params in trials},
                             [seed], k, None, max(1, parallelism) * k, [label])
    scores = preds.groupBy("model").agg(accuracy_at("prob", label, 0.5).alias("a")).collect()
    acc = {r["model"]: float(r["a"]) for r in scores}
    rows = [(t, str(sorted(params.items())), acc[f"trial_{t}"]) for t, params in trials]
    return train.sparkSession.createDataFrame(rows, "trial int, params string, accuracy double")


def feature_importance_pruning(train: DataFrame, label: str, features: Sequence[str],
                               percentile: float = 10, keep_min: int = 10, seed: int = 42) -> DataFrame:
    """Forest impurity importances; the lowest int(n * pct / 100) features are
    dropped, keeping at least ``keep_min``."""
    tr = assemble(train.select(label, *features), features).withColumn("_label", F.col(label).cast("double"))
    model = forest(seed, numTrees=30, maxDepth=6).setFeaturesCol("features").setLabelCol("_label").fit(tr)
    imp = model.featureImportances.toArray().tolist()
    n = len(features)
    n_keep = max(keep_min, n - int(n * percentile / 100))
    order = sorted(range(n), key=lambda i: (imp[i], features[i]))
    dead = set(order[: max(0, n - n_keep)])
    rows = [(features[i], float(imp[i]), int(i not in dead)) for i in range(n)]
    return train.sparkSession.createDataFrame(rows, "feature string, importance double, kept int")


def permutation_importance(train: DataFrame, id_col: str, label: str, features: Sequence[str],
                           seed: int = 42, n_ranges: int = 1024) -> DataFrame:
    """Accuracy drop when one feature's values are permuted across rows (each
    row takes the value of the next row of the whole table by hash, wrapping).
    ``n_ranges`` only cuts the work, it does not change a partner."""
    tr = assemble(train.select(id_col, label, *features), features).withColumn(
        "_label", F.col(label).cast("double"))
    model = forest(seed, numTrees=30, maxDepth=6).setFeaturesCol("features").setLabelCol("_label").fit(tr)
    base = train.select(id_col, label, *features).withColumn("_h", hash32(id_col, seed=f"{seed}:perm"))
    paired = _partner(base, [], id_col, list(features), n_ranges).persist()
    scores = []
    ref = model.transform(tr).agg(accuracy_at(positive_prob(), label, 0.5).alias("a"))
    for c in features:
        shuffled = paired.withColumn(c, F.col(f"_p_{c}"))
        acc = model.transform(assemble(shuffled.select(id_col, label, *features), features)).agg(
            accuracy_at(positive_prob(), label, 0.5).alias("a"))
        scores.append(acc.select(F.lit(c).alias("feature"), F.col("a").alias("permuted_accuracy")))
    out = scores[0]
    for s in scores[1:]:
        out = out.unionByName(s)
    out = out.crossJoin(ref.select(F.col("a").alias("base_accuracy")))
    return out.withColumn("importance", F.col("base_accuracy") - F.col("permuted_accuracy"))


def adversarial_auc(train: DataFrame, test: DataFrame, id_col: str, features: Sequence[str],
                    k: int = 3, seed: int = 42) -> DataFrame:
    """Train-vs-test classifier on numeric features (NULL -> 0), k-fold OOF
    ROC AUC and a band: < 0.60 similar, < 0.70 mild shift, else strong."""
    both = (train.select(id_col, *features).withColumn("_is_test", F.lit(0))
            .unionByName(test.select(id_col, *features).withColumn("_is_test", F.lit(1))))
    preds = fold_runner(both, id_col, "_is_test", features, lambda s, f: forest(s, numTrees=20, maxDepth=5),
                        "adversarial", [seed], k, keep=["_is_test"])
    auc = roc_auc(cut_lineage(preds.select(id_col, "prob", "_is_test")), "prob", "_is_test")
    band = (F.when(F.col("auc") < 0.60, F.lit("similar")).when(F.col("auc") < 0.70, F.lit("mild"))
             .otherwise(F.lit("strong")))
    return auc.withColumn("band", band)


def best_accuracy(df: DataFrame, prob: str, label: str) -> float:
    """Best accuracy over the threshold grid (one pass)."""
    return float(best_threshold(threshold_sweep(df, prob, label)).first()["accuracy"])


def _fit_and_score(rows: DataFrame, apply_rows: DataFrame, id_col: str, label: str,
                   features: Sequence[str], factory, k: int, seed: int):
    """Fold fits on ``rows``: best-cut accuracy and cut on the rows marked
    ``_original`` only (OOF), and the mean prediction of the fold models on ``apply_rows``."""
    preds = cut_lineage(fold_runner(rows, id_col, label, features, factory, "pl", [seed], k, apply_rows, k,
                                    keep=[label, "_original"]))
    oof = preds.where((F.col("kind") == "oof") & F.col("_original"))
    best = best_threshold(threshold_sweep(oof, "prob", label)).first()
    probs = preds.where(F.col("kind") == "apply").groupBy(id_col).agg(F.avg("prob").alias("_p"))
    return float(best["accuracy"]), float(best["threshold"]), probs


def pseudo_label_rounds(train: DataFrame, test: DataFrame, id_col: str, label: str,
                        features: Sequence[str], hi: float = 0.92, rounds: int = 2, k: int = 3,
                        seed: int = 42, factory=None) -> DataFrame:
    """Self-training. Each round: unlabelled rows whose current prediction is
    >= hi or <= 1 - hi get the label p >= (current best cut) and are added to
    the original training rows; the refit is scored on the original rows only
    (best cut) and kept only if strictly better than the best accepted so far.
    Pseudo rows are keyed by id, so a row is never added twice (the newest
    label wins). Stops early when no row is confident. Returns one row per
    round (round 0 = no pseudo rows)."""
    factory = factory or (lambda s, f: forest(s, numTrees=20, maxDepth=6))
    base = train.select(id_col, label, *features, F.lit(True).alias("_original"))
    unl = test.select(id_col, *features)
    acc, cut, probs = _fit_and_score(base, unl, id_col, label, features, factory, k, seed)
    history = [(0, 0, acc, acc, 1)]
    pseudo = None
    for r in range(1, rounds + 1):
        conf = unl.join(probs, id_col).where((F.col("_p") >= hi) | (F.col("_p") <= 1 - hi))
        new = conf.select(id_col, (F.col("_p") >= cut).cast("int").alias(label), *features, F.lit(False).alias("_original")).persist()
        n_new = new.count()
        if n_new == 0:
            break
        cand = new if pseudo is None else pseudo.join(new.select(id_col), id_col, "left_anti").unionByName(new)
        acc_r, cut_r, probs_r = _fit_and_score(base.unionByName(cand), unl, id_col, label, features, factory, k, seed)
        accepted = acc_r > acc
        history.append((r, n_new, acc, acc_r, int(accepted)))
        if accepted:
            acc, cut, probs, pseudo = acc_r, cut_r, probs_r, cand
    return train.sparkSession.createDataFrame(
        history, "round int, n_added bigint, best_before double, accuracy double, accepted int")


def calibrate_if_better(df: DataFrame, id_col: str, prob: str, label: str, apply_to: DataFrame,
                        k: int = 5, seed: int = 42) -> DataFrame:
    """Fold-wise isotonic calibration, used only if its best-cut OOF accuracy
    is strictly higher than the uncalibrated one. Returns the ``apply_to`` rows
    with the probability and cut to use and a ``calibrated`` flag."""
    cal = isotonic_calibration(df, id_col, prob, label, k, seed, apply_to=apply_to)
    oof = cal.where(F.col("kind") == "oof").join(df.select(id_col, label), id_col)
    pre = best_threshold(threshold_sweep(df, prob, label)).select(
        F.col("correct").alias("_c0"), F.col("threshold").alias("_t0"))
    post = best_threshold(threshold_sweep(oof, "cal_prob", label)).select(
        F.col("correct").alias("_c1"), F.col("threshold").alias("_t1"))
    gate = pre.crossJoin(post).select((F.col("_c1") > F.col("_c0")).alias("_use"), "_t0", "_t1")
    ap = apply_to.select(id_col, prob).join(
        cal.where(F.col("kind") == "apply").select(id_col, "cal_prob"), id_col, "left")
    ap = ap.crossJoin(F.broadcast(gate))
    return ap.select(id_col, F.when(F.col("_use"), F.col("cal_prob")).otherwise(F.col(prob)).alias("prob_used"),
                     F.when(F.col("_use"), F.col("_t1")).otherwise(F.col("_t0")).alias("threshold"),
                     F.col("_use").cast("int").alias("calibrated"))
