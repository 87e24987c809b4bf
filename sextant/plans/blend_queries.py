"""The fitted blend over model scores. The two logistic fits have no SQL twin, so the
SQL-checked queries fix their coefficients; weight, candidate, calibration curves, gate,
cut, locks and group step are fitted and applied by the same code and have one. The
isotonic curve in SQL is max over a <= i of min over b >= i of the mean of a..b."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import evaluate
from ..operators.blend import MIX_WEIGHTS, Blend, BlendModel
from ..session import ensure_checkpoint_dir
from .base import MODELS, S_CTE, dlit, query, rnd, scores_view, sql_hash32
from .orders_queries import _RULE
from .score_queries import _CUTS_SQL

INPUTS = [f"p_{m}" for m in MODELS]
STACK = [-1.1, 0.9, 0.8, 0.7]      # intercept, then one coefficient per model
META = [-2.0, 3.0, 1.0]
DIGITS = 2


def _sql_sigmoid(coefficients, inputs) -> str:
    z = " + ".join([dlit(coefficients[0])] + [f"{dlit(w)} * {c}" for w, c in zip(coefficients[1:], inputs)])
    return f"(1.0::DOUBLE / (1.0::DOUBLE + exp(-({z}))))"


def _sql_best(name: str, source: str, group: str = "") -> str:
    """``name``: per candidate of ``source`` (p, y) and cut the rows that are right."""
    keys = f"{group}, " if group else ""
    return (f"{name} AS (SELECT {keys}c.cut_index, c.t, sum(CASE WHEN (p >= c.t) = (y = 1) THEN 1 ELSE 0 END) AS correct, "
            f"count(*) AS n FROM {source}, {_CUTS_SQL} c GROUP BY ALL)")


_CANDS = [("trees", "p_blend"), ("lr_meta", _sql_sigmoid(META, ["p_blend", "p_mlp"]))] + [
    (f"mix_{w:.2f}", f"{dlit(1 - w)} * p_blend + {dlit(w)} * p_mlp") for w in MIX_WEIGHTS]

_FIT_SQL = "WITH " + S_CTE + f""",
st AS (SELECT *, {_sql_sigmoid(STACK, INPUTS)} AS p_stack FROM sa),
wts AS (SELECT * FROM (VALUES {', '.join(f'({j}, {dlit(w)})' for j, w in enumerate(evaluate.weight_grid()))}) v(wi, weight)),
bl AS (SELECT y, wi, weight, weight * p_stack + (1 - weight) * p_avg AS p FROM st, wts WHERE is_train),
{_sql_best("bsw", "bl", "wi, weight")},
bw AS (SELECT weight FROM bsw ORDER BY correct DESC, wi, cut_index LIMIT 1),
fb AS (SELECT st.*, weight, weight * p_stack + (1 - weight) * p_avg AS p_blend FROM st, bw),
cand AS ({' UNION ALL '.join(f"SELECT id, grp, cat, num, y, is_train, '{c}' AS candidate, {i} AS ord, {p} AS p FROM fb"
                             for i, (c, p) in enumerate(_CANDS))}),
ct AS (SELECT * FROM cand WHERE is_train),
{_sql_best("csw", "ct", "candidate, ord")},
win AS (SELECT candidate, t, correct, n FROM csw ORDER BY correct DESC, ord, cut_index LIMIT 1),
fin AS (SELECT id, grp, cat, num, y, is_train, p, round(p, {DIGITS}) AS x FROM cand JOIN win USING (candidate)),
fold AS (SELECT id, y, x, (row_number() OVER (PARTITION BY y ORDER BY {sql_hash32('id', 42)}, id) - 1) % 5 AS fold
         FROM fin WHERE is_train),
pts AS (SELECT fit, x, sum(y) AS s, count(*) AS n FROM fold JOIN (SELECT unnest(range(5)) AS fit) ON fit <> fold GROUP BY ALL),
cum AS (SELECT fit, x, s, n, row_number() OVER w AS i, sum(s) OVER w AS cs, sum(n) OVER w AS cn FROM pts
        WINDOW w AS (PARTITION BY fit ORDER BY x)),
av AS (SELECT a.fit, a.i AS a, b.i AS b, CAST(b.cs - a.cs + a.s AS DOUBLE) / CAST(b.cn - a.cn + a.n AS DOUBLE) AS m
       FROM cum a JOIN cum b ON a.fit = b.fit AND b.i >= a.i),
mn AS (SELECT c.fit, c.x, v.a, min(v.m) AS m FROM cum c JOIN av v ON v.fit = c.fit AND v.a <= c.i AND v.b >= c.i GROUP BY ALL),
iso AS (SELECT fit, x, max(m) AS v FROM mn GROUP BY ALL),
near AS (SELECT q.x, fit, max(iso.x) FILTER (iso.x <= q.x) AS x0, arg_max(v, iso.x) FILTER (iso.x <= q.x) AS y0,
           min(iso.x) FILTER (iso.x >= q.x) AS x1, arg_min(v, iso.x) FILTER (iso.x >= q.x) AS y1
         FROM (SELECT DISTINCT x FROM fin) q, iso GROUP BY ALL),
val AS (SELECT x, fit, CASE WHEN x0 IS NULL THEN y1 WHEN x1 IS NULL OR x0 = x1 THEN y0
          ELSE y0 + (y1 - y0) / (x1 - x0) * (x - x0) END AS v FROM near),
oof AS (SELECT y, v AS p FROM fold JOIN val ON val.fit = fold.fold AND val.x = fold.x),
{_sql_best("osw", "oof")},
post AS (SELECT t, correct, n FROM osw ORDER BY correct DESC, cut_index LIMIT 1),
gate AS (SELECT post.correct > win.correct AS used, CASE WHEN post.correct > win.correct THEN post.t ELSE win.t END AS t,
           candidate, win.correct / win.n AS raw, post.correct / post.n AS cal, weight FROM win, post, bw)"""


def _blend() -> Blend:
    return Blend(inputCols=INPUTS, netCol="p_mlp", labelCol="y", stack=STACK, meta=META, digits=DIGITS)


def _kept(spark, model: BlendModel) -> BlendModel:
    """The model saved in the shared folder and loaded again."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/blend-{uuid.uuid4().hex}"
    model.write().save(path)
    return BlendModel.load(path)


@query("blend_fit", sql=_FIT_SQL + """
SELECT round(weight, 4) AS weight, candidate AS winner, round(t, 4) AS threshold, CAST(used AS INTEGER) AS calibrated,
  round(raw, 6) AS raw_accuracy, round(cal, 6) AS calibrated_accuracy FROM gate""")
def blend_fit(spark, sf):
    m = _kept(spark, _blend().fit(scores_view(spark, sf).where("is_train")))
    values = [m.getOrDefault(p) for p in (m.weight, m.winner, m.threshold, m.calibrated, m.rawAccuracy, m.calibratedAccuracy)]
    row = spark.createDataFrame([(values[0], values[1], values[2], int(values[3]), values[4], values[5])],
                                "weight double, winner string, threshold double, calibrated int, "
                                "raw_accuracy double, calibrated_accuracy double")
    return row.select(rnd("weight", 4).alias("weight"), "winner", rnd("threshold", 4).alias("threshold"), "calibrated",
                      rnd("raw_accuracy").alias("raw_accuracy"), rnd("calibrated_accuracy").alias("calibrated_accuracy"))


@query("blend_decisions", sql=_FIT_SQL + f""",
mv AS (SELECT x, sum(v) / 5.0::DOUBLE AS m FROM val GROUP BY x),
te AS (SELECT id, grp, CASE WHEN {_RULE} THEN 1 END AS locked, CASE WHEN used THEN m ELSE p END AS p, t
       FROM fin JOIN mv USING (x), gate WHERE NOT is_train),
gs AS (SELECT grp, count(*) AS n, avg(p) AS m FROM te GROUP BY grp),
gc AS (SELECT te.*, CASE WHEN locked IS NOT NULL THEN p WHEN n >= 3 AND m > 0.75 THEN least(greatest(p * 0.7 + 0.3, 0.5), 1.0)
         WHEN n >= 3 AND m < 0.25 THEN least(greatest(p * 0.7, 0.0), 0.5) ELSE p END AS gp,
         CAST(n >= 3 AND (m > 0.75 OR m < 0.25) AS INTEGER) AS group_adjusted FROM te JOIN gs USING (grp))
SELECT id, round(p, 6) AS blend_prob, round(t, 4) AS threshold, coalesce(locked, CAST(p >= t AS INTEGER)) AS decision,
  round(gp, 6) AS group_prob, group_adjusted, coalesce(locked, CAST(gp >= t AS INTEGER)) AS group_decision FROM gc""")
def blend_decisions(spark, sf):
    """Decisions for the unlabelled rows by the saved and loaded model."""
    s = scores_view(spark, sf)
    m = _kept(spark, _blend().fit(s.where("is_train"))).with_columns(groupCol="grp", lockCol="locked")
    te = s.where("NOT is_train").select("id", "grp", *INPUTS, "p_mlp", F.when(F.expr(_RULE), F.lit(1)).alias("locked"))
    out = m.transform(te)
    return out.select("id", rnd("blend_prob").alias("blend_prob"), rnd("threshold", 4).alias("threshold"), "decision",
                      rnd("group_prob").alias("group_prob"), "group_adjusted", "group_decision")
