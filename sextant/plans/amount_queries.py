"""Queries over per-user amounts (view E5: events pivoted to five amounts,
joined to the user's customer segment): row arithmetic, entropy, arg-max,
logs, amount imputation, interactions, clipping, scaling, event profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions.columns import argmax_name, flag, positive_count, row_entropy, row_sum, safe_divide
from ..operators import encode, impute, profile, stats
from ..sources.tables import read_table
from .base import AMOUNTS, E5_CTE, EVENT_TYPES, amounts_view, dlit, query, rnd

W = "WITH " + E5_CTE


def _sql_sum(cols):
    return "(" + " + ".join(f"coalesce({c}, 0.0)" for c in cols) + ")"


# P4 / P5 / P6 ---------------------------------------------------------------
@query("row_spend_features", sql=W + f"""
, x AS (SELECT user_id, {_sql_sum(AMOUNTS)} AS total,
               ({' + '.join(f'CAST(coalesce({c} > 0, false) AS INTEGER)' for c in AMOUNTS)}) AS n_positive FROM e5)
SELECT user_id, round(total, 4) AS total, n_positive,
       CAST(coalesce(total = 0, false) AS INTEGER) AS no_spend,
       round(total / CASE WHEN n_positive = 0 THEN 1 ELSE n_positive END, 6) AS avg_per_used
FROM x""")
def row_spend_features(spark, sf):
    e = amounts_view(spark, sf)
    x = e.select("user_id", row_sum(AMOUNTS).alias("total"), positive_count(AMOUNTS).alias("n_positive"))
    return x.select("user_id", rnd("total", 4).alias("total"), "n_positive",
                    flag(F.col("total") == 0).alias("no_spend"),
                    rnd(safe_divide("total", "n_positive")).alias("avg_per_used"))


@query("group_spend_ratios", sql=W + f"""
, x AS (SELECT user_id, seg, CASE WHEN user_id % 9 = 4 THEN 0.0 ELSE {_sql_sum(AMOUNTS)} END AS total FROM e5)
, g AS (SELECT seg, count(*) AS n, sum(total) AS spend FROM x GROUP BY seg)
SELECT x.user_id, g.n AS members, round(g.spend / CASE WHEN g.n = 0 THEN 1 ELSE g.n END, 3) AS per_member,
       round(x.total / CASE WHEN g.n = 0 THEN 1 ELSE g.n END, 6) AS share_of_one
FROM x LEFT JOIN g ON x.seg IS NOT DISTINCT FROM g.seg""")
def group_spend_ratios(spark, sf):
    """A group's spend per member, and a row's spend over the group's size; rows without a group are a group."""
    e = amounts_view(spark, sf).withColumn("_key", F.coalesce(F.concat(F.lit("="), "seg"), F.lit("")))
    x = e.select("user_id", "_key", F.when(F.col("user_id") % 9 == 4, 0.0).otherwise(row_sum(AMOUNTS)).alias("total"))
    g = x.groupBy("_key").agg(F.count(F.lit(1)).alias("members"), F.sum("total").alias("_spend"))
    x = stats.lookup(x, g, "_key")
    return x.select("user_id", "members", rnd(safe_divide("_spend", "members"), 3).alias("per_member"),
                    rnd(safe_divide("total", "members")).alias("share_of_one"))


def _sql_entropy(cols):
    den = f"(CASE WHEN {_sql_sum(cols)} = 0 THEN 1.0 ELSE {_sql_sum(cols)} END)"
    terms = []
    for c in cols:
        p = f"least(greatest({c} / {den}, 0.0), 1.0)"
        p = f"(CASE WHEN {p} = 0 THEN {dlit(1e-9)} ELSE {p} END)"
        terms.append(f"({p} * ln({p}))")
    return "-(" + " + ".join(terms) + ")"


# P7 -------------------------------------------------------------------------
@query("spend_entropy", sql=W + f"""
SELECT user_id, round({_sql_entropy(AMOUNTS)}, 6) AS entropy FROM e5""")
def spend_entropy(spark, sf):
    e = amounts_view(spark, sf)
    return e.select("user_id", rnd(row_entropy(AMOUNTS)).alias("entropy"))


# P8 -------------------------------------------------------------------------
@query("argmax_category", sql=W + f"""
SELECT user_id, CASE {' '.join(f"WHEN {c} = greatest({', '.join(AMOUNTS)}) THEN '{t}'" for c, t in zip(AMOUNTS, EVENT_TYPES))} END AS max_category
FROM e5""")
def argmax_category(spark, sf):
    e = amounts_view(spark, sf)
    return e.select("user_id", argmax_name(AMOUNTS, EVENT_TYPES).alias("max_category"))


# P9 -------------------------------------------------------------------------
@query("log_transform", sql=W + f"""
SELECT user_id, {', '.join(f'round(ln(1 + {c}), 6) AS log_{c}' for c in AMOUNTS)},
       round(ln(1 + {_sql_sum(AMOUNTS)}), 6) AS log_total
FROM e5""")
def log_transform(spark, sf):
    e = amounts_view(spark, sf)
    return e.select("user_id", *[rnd(F.log1p(c)).alias(f"log_{c}") for c in AMOUNTS],
                    rnd(F.log1p(row_sum(AMOUNTS))).alias("log_total"))


# I6 / F2 --------------------------------------------------------------------
def _amounts_nulls(e):
    cols = [F.when((F.col("user_id") + i) % 7 == 0, F.lit(None)).otherwise(F.col(c)).alias(c)
            for i, c in enumerate(AMOUNTS)]
    return e.select("user_id", "seg", (F.col("user_id") % 4 == 1).alias("dormant"), *cols)


_AMOUNTS_NULLS_SQL = ", en AS (SELECT user_id, seg, (user_id % 4 = 1) AS dormant, " + ", ".join(
    f"CASE WHEN (user_id + {i}) % 7 = 0 THEN NULL ELSE {c} END AS {c}" for i, c in enumerate(AMOUNTS)) + " FROM e5)"


@query("impute_amounts", sql=W + _AMOUNTS_NULLS_SQL + f"""
, z AS (SELECT user_id, seg, dormant, {', '.join(f'CASE WHEN dormant THEN 0.0 ELSE {c} END AS {c}' for c in AMOUNTS)} FROM en)
, cm AS (SELECT seg, {', '.join(f'median({c}) AS cm_{c}' for c in AMOUNTS)} FROM z GROUP BY seg)
, gm AS (SELECT {', '.join(f'median({c}) AS gm_{c}' for c in AMOUNTS)} FROM z)
SELECT z.user_id, {', '.join(f'round(CASE WHEN z.dormant THEN 0.0 ELSE coalesce(z.{c}, cm.cm_{c}, gm.gm_{c}) END, 4) AS {c}' for c in AMOUNTS)}
FROM z LEFT JOIN cm ON z.seg = cm.seg CROSS JOIN gm""")
def impute_amounts(spark, sf):
    e = _amounts_nulls(amounts_view(spark, sf))
    out = impute.impute_amounts(e, AMOUNTS, "dormant", "seg")
    return out.select("user_id", *[rnd(c, 4).alias(c) for c in AMOUNTS])


# P11 / P12 ------------------------------------------------------------------
@query("interaction_features", sql=W + f"""
, x AS (SELECT user_id, a_view, (user_id % 4 = 1) AS dormant,
  CASE WHEN user_id % 8 IN (1, 2) THEN 0.0 ELSE {_sql_sum(AMOUNTS)} END AS total FROM e5)
SELECT user_id, round(a_view * ln(1 + total), 4) AS view_x_log_total,
       CAST(dormant AND total = 0 AS INTEGER) AS dormant_no_spend,
       CAST(NOT dormant AND total > 0 AS INTEGER) AS active_has_spend
FROM x""")
def interaction_features(spark, sf):
    e = amounts_view(spark, sf)
    x = e.select("user_id", "a_view", (F.col("user_id") % 4 == 1).alias("dormant"),
                 F.when((F.col("user_id") % 8).isin(1, 2), F.lit(0.0)).otherwise(row_sum(AMOUNTS)).alias("total"))
    return x.select("user_id", rnd(F.col("a_view") * F.log1p("total"), 4).alias("view_x_log_total"),
                    flag(F.col("dormant") & (F.col("total") == 0)).alias("dormant_no_spend"),
                    flag(~F.col("dormant") & (F.col("total") > 0)).alias("active_has_spend"))


# F9 -------------------------------------------------------------------------
@query("winsorize", sql=W + f"""
, q AS (SELECT {', '.join(f'quantile_cont({c}, 0.99) AS q_{c}' for c in AMOUNTS)} FROM e5)
SELECT user_id, {', '.join(f'round(least({c}, q_{c}), 4) AS {c}' for c in AMOUNTS)} FROM e5, q""")
def winsorize(spark, sf):
    e = amounts_view(spark, sf).select("user_id", *AMOUNTS)
    w = profile.winsorize(e, AMOUNTS, 0.99)
    return w.select("user_id", *[rnd(c, 4).alias(c) for c in AMOUNTS])


# E7 -------------------------------------------------------------------------
@query("standard_scale", sql=W + f"""
, st AS (SELECT {', '.join(f'avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}' for c in AMOUNTS)} FROM e5)
SELECT user_id, {', '.join(f'round(({c} - mu_{c}) / CASE WHEN sd_{c} = 0 THEN 1.0 ELSE sd_{c} END, 6) AS {c}' for c in AMOUNTS)}
FROM e5, st""")
def standard_scale(spark, sf):
    e = amounts_view(spark, sf).select("user_id", *AMOUNTS)
    s = encode.standard_scale(e, AMOUNTS)
    return s.select("user_id", *[rnd(c).alias(c) for c in AMOUNTS])


# F8 + A13 -------------------------------------------------------------------
@query("trimmed_histogram", sql="""
WITH q AS (SELECT event_type, quantile_cont(value, 0.98) AS q FROM events GROUP BY event_type)
, t AS (SELECT e.event_type, e.value FROM events e JOIN q ON e.event_type = q.event_type WHERE e.value < q.q)
, r AS (SELECT event_type, min(value) AS lo, max(value) AS hi FROM t GROUP BY event_type)
SELECT t.event_type, CAST(CASE WHEN r.hi = r.lo THEN 0 ELSE least(floor((t.value - r.lo) / ((r.hi - r.lo) / 40)), 39) END AS INTEGER) AS bin,
       count(*) AS n, min(r.lo) AS lo, min(r.hi) AS hi
FROM t JOIN r ON t.event_type = r.event_type GROUP BY ALL""")
def trimmed_histogram(spark, sf):
    ev = read_table(spark, sf, "events").select("event_type", "value")
    t = profile.trim_by_class_quantile(ev, "value", "event_type", 0.98)
    return profile.class_histogram(t, "value", "event_type", 40)


# A14 ------------------------------------------------------------------------
@query("boxplot_stats", sql="""
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, median(value) AS med,
                  quantile_cont(value, 0.75) AS q3 FROM events GROUP BY event_type)
SELECT e.event_type, round(min(q.q1), 4) AS q1, round(min(q.med), 4) AS median, round(min(q.q3), 4) AS q3,
       round(min(CASE WHEN e.value >= q.q1 - 1.5 * (q.q3 - q.q1) THEN e.value END), 4) AS whisker_lo,
       round(max(CASE WHEN e.value <= q.q3 + 1.5 * (q.q3 - q.q1) THEN e.value END), 4) AS whisker_hi,
       CAST(sum(CASE WHEN e.value < q.q1 - 1.5 * (q.q3 - q.q1) OR e.value > q.q3 + 1.5 * (q.q3 - q.q1)
                THEN 1 ELSE 0 END) AS BIGINT) AS n_outliers
FROM events e JOIN q ON e.event_type = q.event_type GROUP BY e.event_type""")
def boxplot_stats(spark, sf):
    ev = read_table(spark, sf, "events").select("event_type", "value")
    b = profile.boxplot_stats(ev, "value", ["event_type"])
    return b.select("event_type", *[rnd(c, 4).alias(c) for c in ["q1", "median", "q3", "whisker_lo", "whisker_hi"]],
                    "n_outliers")
