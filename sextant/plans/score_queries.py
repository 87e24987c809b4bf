"""Queries over model scores (view S: O plus stand-in probabilities): metrics,
threshold and weight search, blends, group post-processing, outputs,
augmentation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import uniform
from ..operators import augment, evaluate, folds, groups, stats
from .base import MODELS, S_CTE, dlit, query, rnd, score, scores_view, sql_hash32, sql_normal, sql_score, sql_uniform
from .orders_queries import REPEAT_SEEDS, _RULE

W = "WITH " + S_CTE

_MODEL_LONG_SQL = " UNION ALL ".join(
    f"SELECT id, y, is_train, '{m}' AS model, p_{m} AS p FROM sa" for m in MODELS)
_CUTS_SQL = "(SELECT CAST(i AS INTEGER) AS cut_index, CAST(3500 + 25 * i AS DOUBLE) / CAST(10000 AS DOUBLE) AS t FROM range(121) r(i))"


def _long(spark, sf, train_only=True):
    s = scores_view(spark, sf)
    if train_only:
        s = s.where("is_train")
    return evaluate.stack_candidates(s.drop("label").withColumnRenamed("y", "label"), "id", "label",
                                     {m: F.col(f"p_{m}") for m in MODELS}).withColumnRenamed("candidate", "model")


# M7 -----------------------------------------------------------------------
@query("accuracy_at_threshold", sql=W + f"""
, l AS ({_MODEL_LONG_SQL})
SELECT model, round(avg(CASE WHEN CAST(p >= 0.5 AS INTEGER) = y THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM l WHERE is_train GROUP BY model""")
def accuracy_at_threshold(spark, sf):
    lg = _long(spark, sf)
    return lg.groupBy("model").agg(rnd(evaluate.accuracy_at("prob", "label", 0.5)).alias("accuracy"))


# N1 / W4 ------------------------------------------------------------------
_SWEEP_SQL = f"""
, l AS ({_MODEL_LONG_SQL})
, sw AS (SELECT model, c.cut_index, c.t AS threshold,
                sum(CASE WHEN (p >= c.t) = (y = 1) THEN 1 ELSE 0 END) AS correct, count(*) AS n
         FROM l, {_CUTS_SQL} c WHERE is_train GROUP BY model, c.cut_index, c.t)"""


@query("threshold_sweep", sql=W + _SWEEP_SQL + """
SELECT model, cut_index, round(threshold, 4) AS threshold, CAST(correct AS BIGINT) AS correct,
       n, round(correct / n, 6) AS accuracy FROM sw""")
def threshold_sweep(spark, sf):
    sw = evaluate.threshold_sweep(_long(spark, sf), "prob", "label", ["model"])
    return sw.select("model", "cut_index", rnd("threshold", 4).alias("threshold"), "correct", "n",
                     rnd("accuracy").alias("accuracy"))


@query("best_threshold", sql=W + _SWEEP_SQL + """
SELECT model, cut_index, round(threshold, 4) AS threshold, CAST(correct AS BIGINT) AS correct,
       round(correct / n, 6) AS accuracy
FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY correct DESC, cut_index) AS rn FROM sw)
WHERE rn = 1""")
def best_threshold(spark, sf):
    b = evaluate.best_threshold(evaluate.threshold_sweep(_long(spark, sf), "prob", "label", ["model"]),
                                ["model"])
    return b.select("model", "cut_index", rnd("threshold", 4).alias("threshold"), "correct",
                    rnd("accuracy").alias("accuracy"))


# N2 -----------------------------------------------------------------------
@query("blend_average", sql=W + """
SELECT id, round(p_avg, 6) AS p_avg FROM sa""")
def blend_average(spark, sf):
    return scores_view(spark, sf).select("id", rnd("p_avg").alias("p_avg"))


# N3 -----------------------------------------------------------------------
WEIGHTS = [round(0.2 + 0.025 * j, 4) for j in range(25)]   # 0.2 ... 0.8


@query("blend_weight_search", sql=W + f"""
, wts AS (SELECT * FROM (VALUES {', '.join(f'({j}, {dlit(w)})' for j, w in enumerate(WEIGHTS))}) v(weight_index, weight))
, bl AS (SELECT sa.y, w.weight_index, w.weight,
                w.weight * sa.p_m1 + (1 - w.weight) * ((sa.p_m2 + sa.p_m3) / CAST(2 AS DOUBLE)) AS p
         FROM sa, wts w WHERE sa.is_train)
, sw AS (SELECT weight_index, weight, c.cut_index, c.t,
                sum(CASE WHEN (p >= c.t) = (y = 1) THEN 1 ELSE 0 END) AS correct, count(*) AS n
         FROM bl, {_CUTS_SQL} c GROUP BY weight_index, weight, c.cut_index, c.t)
, best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY weight_index
           ORDER BY correct DESC, cut_index) AS rn FROM sw) WHERE rn = 1)
SELECT CAST(weight_index AS INTEGER) AS weight_index, round(weight, 4) AS weight, cut_index,
       round(t, 4) AS threshold, CAST(correct AS BIGINT) AS correct, round(correct / n, 6) AS accuracy,
       CAST(row_number() OVER (ORDER BY correct DESC, weight_index) = 1 AS INTEGER) AS is_best
FROM best""")
def blend_weight_search(spark, sf):
    s = scores_view(spark, sf).where("is_train").select(
        "y", F.col("p_m1").alias("a"), ((F.col("p_m2") + F.col("p_m3")) / F.lit(2.0)).alias("b"))
    res = evaluate.blend_weight_search(s, "y", "a", "b", WEIGHTS)
    win = evaluate.first_strict_best(res, "weight_index").select(F.col("weight_index").alias("_w"))
    res = res.join(F.broadcast(win), F.col("weight_index") == F.col("_w"), "left")
    return res.select(F.col("weight_index").cast("int").alias("weight_index"), rnd("weight", 4).alias("weight"),
                      "cut_index", rnd("threshold", 4).alias("threshold"), "correct",
                      rnd("accuracy").alias("accuracy"), F.col("_w").isNotNull().cast("int").alias("is_best"))


# N4 -----------------------------------------------------------------------
MLP_WEIGHTS = [0.05, 0.10, 0.15, 0.20, 0.25, 0.30]


def _cand_defs():
    c = {"trees": (0, F.col("p_avg"))}
    for i, w in enumerate(MLP_WEIGHTS, start=1):
        c[f"mix_{w:.2f}"] = (i, F.lit(1 - w) * F.col("p_avg") + F.lit(w) * F.col("p_mlp"))
    return c


@query("blend_candidates", sql=W + """
, c AS (SELECT id, y, is_train, 'trees' AS candidate, 0 AS ord, p_avg AS p FROM sa""" + "".join(
    f"\n UNION ALL SELECT id, y, is_train, 'mix_{w:.2f}', {i}, {dlit(1 - w)} * p_avg + {dlit(w)} * p_mlp FROM sa"
    for i, w in enumerate(MLP_WEIGHTS, start=1)) + f""")
, sw AS (SELECT candidate, ord, c2.cut_index, c2.t,
                sum(CASE WHEN (p >= c2.t) = (y = 1) THEN 1 ELSE 0 END) AS correct, count(*) AS n
         FROM c, {_CUTS_SQL} c2 WHERE is_train GROUP BY candidate, ord, c2.cut_index, c2.t)
, best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY candidate
           ORDER BY correct DESC, cut_index) AS rn FROM sw) WHERE rn = 1)
SELECT candidate, cut_index, round(t, 4) AS threshold, CAST(correct AS BIGINT) AS correct,
       round(correct / n, 6) AS accuracy,
       CAST(row_number() OVER (ORDER BY correct DESC, ord) = 1 AS INTEGER) AS chosen
FROM best""")
def blend_candidates(spark, sf):
    s = scores_view(spark, sf).where("is_train")
    defs = _cand_defs()
    order = sorted(defs, key=lambda k: defs[k][0])        # trees first: it wins ties
    best = evaluate.choose_candidate(s, "id", "y", {k: v for k, (_, v) in defs.items()}, order)
    return best.select("candidate", "cut_index", rnd("threshold", 4).alias("threshold"), "correct",
                       rnd("accuracy").alias("accuracy"), "chosen")


# J6 -----------------------------------------------------------------------
@query("oof_matrix", sql=W + f"""
, l AS ({_MODEL_LONG_SQL})
SELECT id, {', '.join(f"round(max(CASE WHEN model = '{m}' THEN p END), 6) AS {m}" for m in MODELS)}
FROM l WHERE is_train GROUP BY id""")
def oof_matrix(spark, sf):
    lg = _long(spark, sf)
    wide = lg.groupBy("id").pivot("model", MODELS).agg(F.first("prob"))
    return wide.select("id", *[rnd(m).alias(m) for m in MODELS])


# D3 / D4 ------------------------------------------------------------------
def _seed_long_sql() -> str:
    parts = []
    for m in MODELS:
        for s in REPEAT_SEEDS:
            parts.append(f"SELECT id, '{m}' AS model, {s} AS seed, {sql_score('id', f'{m}:{s}')} AS p FROM sa WHERE is_train")
    return " UNION ALL ".join(parts)


@query("oof_average", sql=W + f"""
, l AS ({_seed_long_sql()})
SELECT id, model, round(sum(p) / greatest(count(p), 1), 6) AS prob, count(p) AS n_preds
FROM l GROUP BY id, model""")
def oof_average(spark, sf):
    s = scores_view(spark, sf).where("is_train").select("id", "y")
    combos = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(sd).alias("seed"))
                                 for m in MODELS for sd in REPEAT_SEEDS])).alias("_ms")
    lg = s.select("id", "y", combos).select("id", "y", "_ms.model", "_ms.seed")
    tag = F.concat(F.col("model"), F.lit(":"), F.col("seed").cast("string"))
    from ..functions.hashing import hash32
    u = hash32(F.col("id"), tag, seed=None)   # md5(id || ':' || model || ':' || seed)
    lg = lg.withColumn("prob", F.lit(0.7) * (u / F.lit(float(2 ** 32))) + F.lit(0.3) * F.col("y"))
    out = folds.oof_average(lg, ["id", "model"], "prob")
    return out.select("id", "model", rnd("prob").alias("prob"), "n_preds")


# N6 -----------------------------------------------------------------------
_GC_SQL = f"""
, te AS (SELECT id, grp, p_avg, CASE WHEN {_RULE} THEN 1 END AS locked FROM sa WHERE NOT is_train)
, gs AS (SELECT grp, count(*) AS n, avg(p_avg) AS m FROM te GROUP BY grp)
, gc AS (SELECT te.id, te.locked, te.p_avg,
         CASE WHEN te.locked IS NOT NULL THEN te.p_avg
              WHEN gs.n >= 3 AND gs.m > 0.75 THEN least(greatest(te.p_avg * 0.7 + 0.3, 0.5), 1.0)
              WHEN gs.n >= 3 AND gs.m < 0.25 THEN least(greatest(te.p_avg * 0.7, 0.0), 0.5)
              ELSE te.p_avg END AS prob_adj,
         CAST(gs.n >= 3 AND (gs.m > 0.75 OR gs.m < 0.25) AS INTEGER) AS adjusted
         FROM te JOIN gs ON te.grp = gs.grp)"""


def _group_adjusted(spark, sf):
    s = scores_view(spark, sf).where("NOT is_train")
    te = s.select("id", "grp", "p_avg", F.when(F.expr(_RULE), F.lit(1)).alias("locked"))
    return groups.group_consistency(te, "grp", "p_avg", "locked", 0.75, 3)


@query("group_consistency", sql=W + _GC_SQL + """
SELECT id, round(prob_adj, 6) AS prob_adj, adjusted FROM gc""")
def group_consistency(spark, sf):
    g = _group_adjusted(spark, sf)
    return g.select("id", rnd("prob_adj").alias("prob_adj"), "adjusted")


# F6 / N7 ------------------------------------------------------------------
@query("priority_merge", sql=W + f"""
, st AS (SELECT grp, avg(label) AS m, count(label) AS n FROM sa WHERE is_train GROUP BY grp)
, x AS (SELECT t.id, CASE WHEN {_RULE.replace('cat', 't.cat').replace('num', 't.num')} THEN 1 END AS hard,
               CASE WHEN st.n > 1 AND st.m >= 0.95 THEN 1 WHEN st.n > 1 AND st.m <= 0.05 THEN 0 END AS grp_lock,
               CAST(t.p_avg >= 0.5 AS INTEGER) AS model
        FROM sa t LEFT JOIN st ON t.grp = st.grp WHERE NOT t.is_train)
SELECT id, coalesce(hard, grp_lock, model) AS final,
       CASE WHEN hard IS NOT NULL THEN 'hard' WHEN grp_lock IS NOT NULL THEN 'group' ELSE 'model' END AS source
FROM x""")
def priority_merge(spark, sf):
    s = scores_view(spark, sf)
    tr, te = s.where("is_train"), s.where("NOT is_train")
    st = tr.groupBy("grp").agg(F.avg("label").alias("_m"), F.count("label").alias("_n"))
    x = stats.lookup(te.select("id", "grp", "cat", "num", "p_avg"), st, "grp")
    hard = F.when(F.expr(_RULE), F.lit(1))
    grp_lock = (F.when((F.col("_n") > 1) & (F.col("_m") >= 0.95), F.lit(1))
                 .when((F.col("_n") > 1) & (F.col("_m") <= 0.05), F.lit(0)))
    x = x.select("id", hard.alias("hard"), grp_lock.alias("grp_lock"),
                 (F.col("p_avg") >= 0.5).cast("int").alias("model"))
    src = (F.when(F.col("hard").isNotNull(), F.lit("hard"))
            .when(F.col("grp_lock").isNotNull(), F.lit("group")).otherwise(F.lit("model")))
    return x.select("id", F.coalesce("hard", "grp_lock", "model").alias("final"), src.alias("source"))


# S2 -----------------------------------------------------------------------
_BEST_AVG_SQL = f"""
, swa AS (SELECT c.cut_index, c.t, sum(CASE WHEN (p_avg >= c.t) = (y = 1) THEN 1 ELSE 0 END) AS correct
          FROM sa, {_CUTS_SQL} c WHERE is_train GROUP BY c.cut_index, c.t)
, bt AS (SELECT t FROM swa ORDER BY correct DESC, cut_index LIMIT 1)"""


def _best_avg_threshold(spark, sf):
    s = scores_view(spark, sf).where("is_train")
    return evaluate.best_threshold(evaluate.threshold_sweep(s, "p_avg", "y")).select(
        F.col("threshold").alias("_t"))


@query("submission_output", sql=W + _BEST_AVG_SQL + f"""
SELECT id AS o_orderkey, CAST(coalesce(CASE WHEN {_RULE} THEN 1 END, CAST(p_avg >= bt.t AS INTEGER)) AS BOOLEAN)
       AS prediction
FROM sa, bt WHERE NOT is_train""")
def submission_output(spark, sf):
    te = scores_view(spark, sf).where("NOT is_train")
    x = stats.attach_global(te, _best_avg_threshold(spark, sf))
    pred = F.coalesce(F.when(F.expr(_RULE), F.lit(1)), (F.col("p_avg") >= F.col("_t")).cast("int"))
    return x.select(F.col("id").alias("o_orderkey"), pred.cast("boolean").alias("prediction"))


# S3 / A19 -----------------------------------------------------------------
@query("submission_variants", sql=W + _BEST_AVG_SQL + _GC_SQL + """
, v AS (SELECT coalesce(gc.locked, CAST(gc.p_avg >= bt.t AS INTEGER)) AS no_group,
               coalesce(gc.locked, CAST(gc.prob_adj >= bt.t AS INTEGER)) AS with_group,
               CAST(gc.p_avg >= 0.5 AS INTEGER) AS raw
        FROM gc, bt)
SELECT 'no_group' AS variant, round(avg(no_group), 6) AS positive_rate, count(*) AS n FROM v
UNION ALL SELECT 'with_group', round(avg(with_group), 6), count(*) FROM v
UNION ALL SELECT 'raw', round(avg(raw), 6), count(*) FROM v""")
def submission_variants(spark, sf):
    g = stats.attach_global(_group_adjusted(spark, sf), _best_avg_threshold(spark, sf))
    v = g.select(F.coalesce("locked", (F.col("p_avg") >= F.col("_t")).cast("int")).alias("no_group"),
                 F.coalesce("locked", (F.col("prob_adj") >= F.col("_t")).cast("int")).alias("with_group"),
                 (F.col("p_avg") >= 0.5).cast("int").alias("raw"))
    one = v.agg(*[F.avg(c).alias(c) for c in ["no_group", "with_group", "raw"]],
                F.count(F.lit(1)).alias("n"))
    long = one.unpivot(["n"], ["no_group", "with_group", "raw"], "variant", "positive_rate")
    return long.select("variant", rnd("positive_rate").alias("positive_rate"), "n")


@query("prediction_variants", sql=W + _BEST_AVG_SQL + _GC_SQL + """
SELECT id, coalesce(locked, CAST(p_avg >= bt.t AS INTEGER)) = 1 AS no_group,
       coalesce(locked, CAST(prob_adj >= bt.t AS INTEGER)) = 1 AS with_group, p_avg >= 0.5 AS raw
FROM gc, bt""")
def prediction_variants(spark, sf):
    """The predictions themselves, one boolean column per variant."""
    g = stats.attach_global(_group_adjusted(spark, sf), _best_avg_threshold(spark, sf))

    def final(prob):
        return F.coalesce(F.col("locked") == 1, F.col(prob) >= F.col("_t"))
    return g.select("id", final("p_avg").alias("no_group"), final("prob_adj").alias("with_group"),
                    (F.col("p_avg") >= 0.5).alias("raw"))


# A18 ----------------------------------------------------------------------
@query("prediction_source_rollup", sql=W + f"""
, x AS (SELECT CASE WHEN {_RULE} THEN 'locked' ELSE 'model' END AS source FROM sa WHERE NOT is_train)
SELECT coalesce(source, 'total') AS source, count(*) AS n,
       round(100.0 * count(*) / (SELECT count(*) FROM x), 4) AS pct
FROM x GROUP BY ROLLUP (source)""")
def prediction_source_rollup(spark, sf):
    te = scores_view(spark, sf).where("NOT is_train")
    x = te.select(F.when(F.expr(_RULE), F.lit("locked")).otherwise(F.lit("model")).alias("source"))
    r = x.rollup("source").agg(F.count(F.lit(1)).alias("n"))
    tot = x.agg(F.count(F.lit(1)).alias("_tot"))
    r = stats.attach_global(r, tot)
    return r.select(F.coalesce("source", F.lit("total")).alias("source"), "n",
                    rnd(F.lit(100.0) * F.col("n") / F.col("_tot"), 4).alias("pct"))


# A17 ----------------------------------------------------------------------
@query("confusion_matrix", sql=W + """
SELECT y AS label, CAST(p_avg >= 0.5 AS INTEGER) AS pred, count(*) AS n FROM sa WHERE is_train GROUP BY ALL""")
def confusion_matrix(spark, sf):
    s = scores_view(spark, sf).where("is_train").withColumn("pred", (F.col("p_avg") >= 0.5).cast("int"))
    return evaluate.confusion_matrix(s, "y", "pred")


# M7 AUC -------------------------------------------------------------------
@query("roc_auc", sql=W + f"""
, l AS ({_MODEL_LONG_SQL})
, r AS (SELECT model, y, rank() OVER (PARTITION BY model ORDER BY p)
                + (count(*) OVER (PARTITION BY model, p) - 1) / 2.0 AS rk FROM l WHERE is_train)
, a AS (SELECT model, sum(CASE WHEN y = 1 THEN rk ELSE 0 END) AS sr, sum(y) AS np, sum(1 - y) AS nn
        FROM r GROUP BY model)
SELECT model, round((sr - np * (np + 1) / 2.0) / (np * nn), 6) AS auc,
       CAST(np AS BIGINT) AS n_pos, CAST(nn AS BIGINT) AS n_neg FROM a""")
def roc_auc(spark, sf):
    a = evaluate.roc_auc(_long(spark, sf), "prob", "label", ["model"])
    return a.select("model", rnd("auc").alias("auc"), "n_pos", "n_neg")


# B5 / N8 ------------------------------------------------------------------
@query("reliability_curve", sql=W + """
SELECT CAST(least(greatest(CAST(ceil(p_avg * 15) AS INTEGER) - 1, 0), 14) AS INTEGER) AS bin,
       round(avg(p_avg), 6) AS mean_predicted, round(avg(CAST(y AS DOUBLE)), 6) AS fraction_positive,
       count(*) AS n
FROM sa WHERE is_train GROUP BY 1""")
def reliability_curve(spark, sf):
    s = scores_view(spark, sf).where("is_train")
    r = evaluate.reliability_curve(s, "p_avg", "y", 15)
    return r.select("bin", rnd("mean_predicted").alias("mean_predicted"),
                    rnd("fraction_positive").alias("fraction_positive"), "n")


@query("probability_histograms", sql=W + f"""
, l AS ({_MODEL_LONG_SQL})
SELECT model, is_train, CAST(least(greatest(floor(p * 30), 0), 29) AS INTEGER) AS bin, count(*) AS n
FROM l GROUP BY ALL""")
def probability_histograms(spark, sf):
    """Every model's scores in 30 even bins of [0, 1], labelled and unlabelled rows apart, from one scan."""
    s = scores_view(spark, sf).select("is_train", *[f"p_{m}" for m in MODELS])
    return evaluate.probability_histograms(s, {m: f"p_{m}" for m in MODELS}, ["is_train"], 30)


# F7 -----------------------------------------------------------------------
@query("pseudo_label_select", sql=W + """
SELECT id, round(p_m1, 6) AS prob, CAST(p_m1 >= 0.5 AS INTEGER) AS pseudo_label
FROM sa WHERE NOT is_train AND (p_m1 >= 0.92 OR p_m1 <= """ + dlit(1 - 0.92) + ")")
def pseudo_label_select(spark, sf):
    te = scores_view(spark, sf).where("NOT is_train")
    sel = te.where((F.col("p_m1") >= 0.92) | (F.col("p_m1") <= 1 - 0.92))
    return sel.select("id", rnd("p_m1").alias("prob"), (F.col("p_m1") >= 0.5).cast("int").alias("pseudo_label"))


# D5 -----------------------------------------------------------------------
@query("mixup_pairs", sql=W + f"""
, p AS (SELECT id, y, num, p_m1, {sql_hash32('id', 42)} AS h,
          {dlit(0.2)} + {dlit(0.6)} * {sql_uniform('id', 'lam')} AS lam FROM sa WHERE is_train)
, q AS (SELECT id, y, num, p_m1, lam,
          coalesce(lead(id) OVER w, first_value(id) OVER wf) AS pid,
          coalesce(lead(y) OVER w, first_value(y) OVER wf) AS py,
          coalesce(lead(num) OVER w, first_value(num) OVER wf) AS pnum,
          coalesce(lead(p_m1) OVER w, first_value(p_m1) OVER wf) AS pp
        FROM p WINDOW w AS (ORDER BY h, id),
                      wf AS (ORDER BY h, id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT id, pid AS partner, round(lam, 6) AS lam,
       round(lam * num + (1 - lam) * pnum, 4) AS num,
       round(lam * p_m1 + (1 - lam) * pp, 6) AS p_m1,
       CASE WHEN lam >= 0.5 THEN y ELSE py END AS y
FROM q""")
def mixup_pairs(spark, sf):
    s = scores_view(spark, sf).where("is_train").select("id", "y", "num", "p_m1")
    lam = F.lit(0.2) + F.lit(0.6) * uniform("id", seed="lam")     # both sides of one half
    m = augment.mixup_pairs(s, "id", ["num", "p_m1"], "y", lam, seed=42)
    return m.select("id", "partner", rnd("lam").alias("lam"), rnd("num", 4).alias("num"), rnd("p_m1").alias("p_m1"), "y")


# D6 -----------------------------------------------------------------------
@query("gaussian_noise", sql=W + f"""
SELECT id, round(num + 0.01 * {sql_normal('id', '42:num')}, 6) AS num,
       round(p_m1 + 0.01 * {sql_normal('id', '42:p_m1')}, 6) AS p_m1
FROM sa WHERE is_train""")
def gaussian_noise(spark, sf):
    s = scores_view(spark, sf).where("is_train").select("id", "num", "p_m1")
    g = augment.gaussian_noise(s, "id", ["num", "p_m1"], 0.01, 42)
    return g.select("id", rnd("num").alias("num"), rnd("p_m1").alias("p_m1"))


# D7 -----------------------------------------------------------------------
@query("group_swap", sql=W + f"""
, b AS (SELECT id, grp, y, num, p_m1, {sql_hash32('id', 42)} AS h FROM sa WHERE is_train)
, q AS (SELECT *, coalesce(lead(id) OVER w, first_value(id) OVER wf) AS pid,
               coalesce(lead(num) OVER w, first_value(num) OVER wf) AS pnum,
               coalesce(lead(p_m1) OVER w, first_value(p_m1) OVER wf) AS pp
        FROM b WINDOW w AS (PARTITION BY grp ORDER BY h, id),
                      wf AS (PARTITION BY grp ORDER BY h, id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT id, grp, y, CASE WHEN grp IS NULL THEN id ELSE pid END AS partner,
       round(CASE WHEN grp IS NOT NULL AND {sql_hash32('id', '42:num')} / CAST(4294967296 AS DOUBLE) < 0.3 THEN pnum ELSE num END, 4) AS num,
       round(CASE WHEN grp IS NOT NULL AND {sql_hash32('id', '42:p_m1')} / CAST(4294967296 AS DOUBLE) < 0.3 THEN pp ELSE p_m1 END, 6) AS p_m1,
       1 AS copy
FROM q UNION ALL SELECT id, grp, y, id, round(num, 4), round(p_m1, 6), 0 FROM b""")
def group_swap(spark, sf):
    s = scores_view(spark, sf).where("is_train").select("id", "grp", "y", "num", "p_m1")
    g = augment.group_swap(s, "id", "grp", ["num", "p_m1"], "y", 0.3, 42)
    return g.select("id", "grp", "y", "partner", rnd("num", 4).alias("num"), rnd("p_m1").alias("p_m1"), "copy")


# A16 / M9 -----------------------------------------------------------------
@query("model_fold_summary", sql=W + f"""
, l AS ({_MODEL_LONG_SQL})
, f AS (SELECT l.*, s.seed, CAST(CAST(('0x' || substr(md5(CAST(id AS VARCHAR) || ':' || CAST(s.seed AS VARCHAR)), 1, 8))
          AS UBIGINT) % 5 AS INTEGER) AS fold
        FROM l, (SELECT unnest([{', '.join(str(x) for x in REPEAT_SEEDS)}]) AS seed) s WHERE is_train)
, a AS (SELECT seed, fold, model, avg(CASE WHEN CAST(p >= 0.5 AS INTEGER) = y THEN 1.0 ELSE 0.0 END) AS acc
        FROM f GROUP BY ALL)
SELECT seed, fold, model, round(acc, 6) AS accuracy, round(avg(acc) OVER (PARTITION BY model), 6) AS model_mean
FROM a""")
def model_fold_summary(spark, sf):
    lg = _long(spark, sf)
    lg = folds.repeated_folds(lg, "id", REPEAT_SEEDS, 5)
    a = lg.groupBy("seed", "fold", "model").agg(evaluate.accuracy_at("prob", "label", 0.5).alias("acc"))
    mm = a.groupBy("model").agg(F.avg("acc").alias("_mm"))
    a = stats.lookup(a, mm, "model")
    return a.select(F.col("seed").cast("int").alias("seed"), "fold", "model", rnd("acc").alias("accuracy"),
                    rnd("_mm").alias("model_mean"))
