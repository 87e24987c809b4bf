"""Model queries (rows-only checks: fits are iterative and have no SQL twin).

Features come from the orders view O: price, priority code, customer order
count, order year and month; label = status 'F'. Settings are small (one seed,
three folds, small forests / boosters); the full 5 x 5 schedule is a
parameter of the operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import augment, encode, models, stats
from ..sources.tables import read_table
from .base import query, scores_view

FEATURES = ["f_num", "f_cat", "f_grp_size", "f_year", "f_month"]


def model_frame(spark, sf):
    o = read_table(spark, sf, "orders")
    k = F.col("o_orderkey")
    base = o.select(k.alias("id"), F.col("o_custkey").alias("grp"), F.col("o_orderpriority").alias("cat"),
                    (k % 3 != 0).alias("is_train"),
                    (F.col("o_orderstatus") == "F").cast("int").alias("y"),
                    F.col("o_totalprice").alias("f_num"),
                    F.year("o_orderdate").cast("double").alias("f_year"),
                    F.month("o_orderdate").cast("double").alias("f_month"))
    base = stats.lookup(base, stats.group_size_table(base, "grp", "_gs"), "grp")
    base = encode.ordinal_encode(base, ["cat"])
    return base.select("id", "grp", "is_train", "y", "f_num", F.col("cat_code").cast("double").alias("f_cat"),
                       F.col("_gs").cast("double").alias("f_grp_size"), "f_year", "f_month")


def _split(spark, sf):
    m = model_frame(spark, sf)
    return m.where("is_train"), m.where("NOT is_train")


def _oof_query(spark, sf, factory, name):
    tr, te = _split(spark, sf)
    preds = models.fold_runner(tr, "id", "y", FEATURES, factory, name, [42], 3, te, parallelism=3)
    return models.average_predictions(preds, "id")


@query("gbt_oof")
def gbt_oof(spark, sf):
    return _oof_query(spark, sf, lambda s, f: models.gbt(s, maxDepth=5, maxIter=15, stepSize=0.1), "gbt")


@query("forest_oof")
def forest_oof(spark, sf):
    return _oof_query(spark, sf, lambda s, f: models.forest(s, numTrees=40, maxDepth=8), "forest")


@query("gbt_variants_oof")
def gbt_variants_oof(spark, sf):
    tr, te = _split(spark, sf)
    variants = {
        "gbt_row85_col80": lambda s, f: models.gbt(s, maxDepth=6, maxIter=15, subsamplingRate=0.85,
                                                   featureSubsetStrategy="0.8"),
        "gbt_depth7": lambda s, f: models.gbt(s, maxDepth=7, maxIter=10, stepSize=0.05),
    }
    out = None
    for name, fac in variants.items():
        p = models.fold_runner(tr, "id", "y", FEATURES, fac, name, [42], 3, te)
        out = p if out is None else out.unionByName(p)
    return models.average_predictions(out, "id")


@query("mlp_oof")
def mlp_oof(spark, sf):
    tr, te = _split(spark, sf)
    # population scaling fitted on the training rows, applied to both
    st = tr.agg(*[F.avg(c).alias(f"_mu_{c}") for c in FEATURES], *[F.stddev_pop(c).alias(f"_sd_{c}") for c in FEATURES])

    def scale(df):
        x = stats.attach_global(df, st)
        for c in FEATURES:
            sd = F.col(f"_sd_{c}")
            x = x.withColumn(c, (F.col(c) - F.col(f"_mu_{c}")) / F.when(sd == 0, F.lit(1.0)).otherwise(sd))
        return x.select("id", "y", *FEATURES)

    preds = models.fold_runner(scale(tr), "id", "y", FEATURES,
                               lambda s, f: models.mlp(len(FEATURES), s, (16, 8), 60), "mlp", [42], 3, scale(te))
    return models.average_predictions(preds, "id")


@query("lr_stack")
def lr_stack(spark, sf):
    s = scores_view(spark, sf)
    tr, te = s.where("is_train"), s.where("NOT is_train")
    return models.stack_logistic(tr, "id", "y", ["p_m1", "p_m2", "p_m3"], C=0.5, apply_to=te)


@query("random_search")
def random_search(spark, sf):
    tr, _ = _split(spark, sf)
    return models.random_search(tr, "id", "y", FEATURES, {"numTrees": (10, 40), "maxDepth": (3, 8)},
                                n_trials=3, k=3, seed=42)


@query("feature_pruning")
def feature_pruning(spark, sf):
    tr, _ = _split(spark, sf)
    return models.feature_importance_pruning(tr, "y", FEATURES, percentile=40, keep_min=3)


@query("permutation_importance")
def permutation_importance(spark, sf):
    tr, _ = _split(spark, sf)
    return models.permutation_importance(tr, "id", "y", FEATURES)


@query("isotonic_calibration")
def isotonic_calibration(spark, sf):
    s = scores_view(spark, sf)
    tr, te = s.where("is_train"), s.where("NOT is_train")
    return models.isotonic_calibration(tr, "id", "p_avg", "y", 5, 42, apply_to=te)


@query("pseudo_label_round")
def pseudo_label_round(spark, sf):
    tr, te = _split(spark, sf)
    return models.pseudo_label_rounds(tr, te, "id", "y", FEATURES, hi=0.92, rounds=2, k=3, seed=42)


@query("calibration_gate")
def calibration_gate(spark, sf):
    s = scores_view(spark, sf)
    tr, te = s.where("is_train"), s.where("NOT is_train")
    return models.calibrate_if_better(tr, "id", "p_avg", "y", te.select("id", "p_avg"), 5, 42)


@query("adversarial_auc")
def adversarial_auc(spark, sf):
    tr, te = _split(spark, sf)
    # numeric columns chosen from the schema (label, split flag and key excluded), NULL -> 0
    feats = stats.numeric_columns(tr, ["id", "y", "grp"])
    tr = stats.numeric_matrix(tr, ["id"], ["y", "grp"])
    te = stats.numeric_matrix(te, ["id"], ["y", "grp"])
    return models.adversarial_auc(tr, te, "id", feats, 3, 42)


@query("mixup_augment")
def mixup_augment(spark, sf):
    tr, _ = _split(spark, sf)
    return augment.mixup_augment(tr.select("id", "y", *FEATURES), "id", FEATURES, "y", alpha=0.4,
                                 multiplier=1, noise_std=0.01, seed=42)


@query("text_svd")
def text_svd(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    return encode.text_svd(d, "doc_id", "text", 5, 1000)


@query("text_svd_full")
def text_svd_full(spark, sf):
    """The same over every term of the corpus."""
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    return encode.text_svd(d, "doc_id", "text", 5, None)


@query("blend_candidates_stacked")
def blend_candidates_stacked(spark, sf):
    """The full candidate choice: logistic meta-blend over (trees, neural net)
    with C = 0.3, the fixed mixes, and trees alone; trees win ties, then the
    meta-blend, then the mixes in order."""
    from ..operators import evaluate
    from .score_queries import MLP_WEIGHTS
    s = scores_view(spark, sf).where("is_train")
    meta = models.stack_logistic(s, "id", "y", ["p_avg", "p_mlp"], C=0.3).select(
        "id", F.col("stack_prob").alias("p_meta"))
    s = s.join(meta, "id")
    cands = {"trees": F.col("p_avg"), "lr_meta": F.col("p_meta")}
    for w in MLP_WEIGHTS:
        cands[f"mix_{w:.2f}"] = F.lit(1 - w) * F.col("p_avg") + F.lit(w) * F.col("p_mlp")
    return evaluate.choose_candidate(s, "id", "y", cands, list(cands))


@query("text_features_oof")
def text_features_oof(spark, sf):
    """Text dimensions feeding a model, as in the source: the SVD is fitted on
    all documents (labelled and not), a forest is cross-validated on the
    labelled ones (label: quality) and scores the rest."""
    d = read_table(spark, sf, "documents").select("doc_id", "text", F.col("n_chars").cast("double").alias("n_chars"))
    lab = read_table(spark, sf, "labels").select("doc_id", "quality")
    svd = encode.text_svd(d.select("doc_id", "text"), "doc_id", "text", 5, 1000)
    feats = svd.join(d.select("doc_id", "n_chars"), "doc_id").withColumnRenamed("doc_id", "id")
    cols = [f"svd_{j}" for j in range(5)] + ["n_chars"]
    labelled = feats.join(lab.withColumnRenamed("doc_id", "id"), "id")
    unlabelled = feats.join(lab.withColumnRenamed("doc_id", "id"), "id", "left_anti")
    preds = models.fold_runner(labelled, "id", "quality", cols,
                               lambda s, f: models.forest(s, numTrees=30, maxDepth=6), "text_forest",
                               [42], 3, unlabelled, parallelism=3)
    return models.average_predictions(preds, "id")
