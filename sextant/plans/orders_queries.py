"""Queries bound to the orders entity view O: scans, set operations, lookups,
imputation, group statistics, label encoders, folds, rules, binning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import equal_width_code, infer_flag_from_amounts, rank_in_edges, flag
from ..functions.hashing import hash32
from ..operators import encode, folds, groups, impute, profile, stats
from ..sources.tables import read_table
from .base import O_CTE, orders_view, query, rnd, sql_hash32, train_test

W = "WITH " + O_CTE


def _mode_sql(src: str, key: str, col: str) -> str:
    """Mode per key in SQL: highest count, smallest value on ties."""
    return (f"(SELECT {key}, {col} AS m FROM (SELECT {key}, {col}, row_number() OVER "
            f"(PARTITION BY {key} ORDER BY count(*) DESC, {col}) AS rn FROM {src} "
            f"WHERE {col} IS NOT NULL GROUP BY {key}, {col}) WHERE rn = 1)")


# S1 ---------------------------------------------------------------------------
@query("scan_profile", sql="""
SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys,
       count(o_orderpriority) AS n_priority, count(DISTINCT o_custkey) AS n_customers,
       round(avg(o_totalprice), 4) AS avg_price, min(o_totalprice) AS min_price,
       max(o_totalprice) AS max_price
FROM orders""")
def scan_profile(spark, sf):
    o = read_table(spark, sf, "orders")
    return o.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("o_orderkey").alias("n_keys"),
                 F.count("o_orderpriority").alias("n_priority"),
                 F.countDistinct("o_custkey").alias("n_customers"),
                 rnd(F.avg("o_totalprice"), 4).alias("avg_price"),
                 F.min("o_totalprice").alias("min_price"), F.max("o_totalprice").alias("max_price"))


# U1 ---------------------------------------------------------------------------
@query("union_train_test", sql=W + """
SELECT id, grp, cat, y AS label, true AS is_train FROM o WHERE is_train
UNION ALL
SELECT id, grp, cat, NULL AS label, false AS is_train FROM o WHERE NOT is_train""")
def union_train_test(spark, sf):
    tr, te = train_test(spark, sf)
    a = tr.select("id", "grp", "cat", F.col("y").alias("label")).withColumn("is_train", F.lit(True))
    b = te.select("id", "grp", "cat").withColumn("is_train", F.lit(False))
    return a.unionByName(b, allowMissingColumns=True)


# F1 ---------------------------------------------------------------------------
@query("infer_flag_from_amounts", sql=W + """
, x AS (SELECT id, CASE WHEN id % 7 = 3 THEN NULL ELSE cat = '1-URGENT' END AS flag_n,
               CASE WHEN id % 5 = 0 THEN 0.0 ELSE num END AS amt1,
               CASE WHEN id % 5 = 0 THEN NULL ELSE 0.0 END AS amt2 FROM o)
SELECT id, CASE WHEN flag_n IS NULL AND coalesce(amt1, 0) + coalesce(amt2, 0) > 0 THEN false
                WHEN flag_n IS NULL AND coalesce(amt1, 0) + coalesce(amt2, 0) = 0 THEN true
                ELSE flag_n END AS flag
FROM x""")
def infer_flag(spark, sf):
    o = orders_view(spark, sf)
    x = o.select("id",
                 F.when(F.col("id") % 7 == 3, F.lit(None)).otherwise(F.col("cat") == "1-URGENT").alias("flag_n"),
                 F.when(F.col("id") % 5 == 0, F.lit(0.0)).otherwise(F.col("num")).alias("amt1"),
                 F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.lit(0.0)).alias("amt2"))
    return x.select("id", infer_flag_from_amounts("flag_n", ["amt1", "amt2"]).alias("flag"))


# I1 / A2 --------------------------------------------------------------------
@query("impute_group_mode", sql=W + f"""
SELECT o.id, coalesce(o.cat_n, m.m) AS cat_n
FROM o LEFT JOIN {_mode_sql('o', 'grp', 'cat_n')} m ON o.grp = m.grp""")
def impute_group_mode(spark, sf):
    o = orders_view(spark, sf).select("id", "grp", "cat_n")
    return impute.impute_group_mode(o, "grp", "cat_n").select("id", "cat_n")


@query("group_mode", sql=W + f"""
SELECT g.grp, m.m AS cat_n_mode
FROM (SELECT DISTINCT grp FROM o) g LEFT JOIN {_mode_sql('o', 'grp', 'cat_n')} m ON g.grp = m.grp""")
def group_mode(spark, sf):
    o = orders_view(spark, sf)
    keys = o.select("grp").distinct()
    return keys.join(stats.mode_table(o, "grp", "cat_n", "cat_n_mode"), "grp", "left")


# I2 / I3 ----------------------------------------------------------------------
@query("impute_category_cascade", sql=W + f"""
, s1 AS (SELECT o.id, o.yr_n, o.cat_n, coalesce(o.cat2_n, m.m) AS cat2_n
         FROM o LEFT JOIN {_mode_sql('o', 'yr_n', 'cat2_n')} m ON o.yr_n = m.yr_n)
, s2 AS (SELECT s1.id, s1.yr_n, s1.cat2_n, coalesce(s1.cat_n, m.m) AS cat_n
         FROM s1 LEFT JOIN {_mode_sql('s1', 'cat2_n', 'cat_n')} m ON s1.cat2_n = m.cat2_n)
, s3 AS (SELECT s2.id, s2.cat2_n, s2.cat_n, coalesce(s2.yr_n, m.m) AS yr_n
         FROM s2 LEFT JOIN {_mode_sql('s2', 'cat2_n', 'yr_n')} m ON s2.cat2_n = m.cat2_n)
, g AS (SELECT (SELECT cat2_n FROM s3 WHERE cat2_n IS NOT NULL GROUP BY cat2_n
                ORDER BY count(*) DESC, cat2_n LIMIT 1) AS g2,
               (SELECT cat_n FROM s3 WHERE cat_n IS NOT NULL GROUP BY cat_n
                ORDER BY count(*) DESC, cat_n LIMIT 1) AS g1)
SELECT id, coalesce(cat2_n, g.g2) AS cat2_n, coalesce(cat_n, g.g1) AS cat_n,
       coalesce(yr_n, 'U') AS yr_n
FROM s3, g""")
def impute_category_cascade(spark, sf):
    o = orders_view(spark, sf).select("id", "yr_n", "cat_n", "cat2_n")
    out = impute.impute_category_cascade(
        o, [("yr_n", "cat2_n"), ("cat2_n", "cat_n"), ("cat2_n", "yr_n")],
        {"cat2_n": "mode", "cat_n": "mode", "yr_n": "U"})
    return out.select("id", "cat2_n", "cat_n", "yr_n")


# I4 / I5 ----------------------------------------------------------------------
@query("impute_median_cascade", sql=W + """
, gm AS (SELECT grp, median(num_n) AS m1 FROM o GROUP BY grp)
, cm AS (SELECT cat, median(num_n) AS m2 FROM o GROUP BY cat)
, x AS (SELECT o.id, o.num_n, gm.m1, cm.m2, (SELECT median(num_n) FROM o) AS m3,
               CASE WHEN o.id % 5 = 2 THEN NULL ELSE o.cat = '2-HIGH' END AS flag_n
        FROM o LEFT JOIN gm ON o.grp = gm.grp LEFT JOIN cm ON o.cat = cm.cat)
SELECT id, round(coalesce(num_n, m1, m2, m3), 4) AS num_filled,
       coalesce(flag_n, false) AS flag
FROM x""")
def impute_median_cascade(spark, sf):
    o = orders_view(spark, sf)
    o = o.select("id", "grp", "cat", "num_n",
                 F.when(F.col("id") % 5 == 2, F.lit(None)).otherwise(F.col("cat") == "2-HIGH").alias("flag_n"))
    out = impute.impute_median_cascade(o, "num_n", ["grp", "cat"])
    out = impute.impute_bool_default(out, "flag_n")
    return out.select("id", rnd("num_n", 4).alias("num_filled"), F.col("flag_n").alias("flag"))


# A4 -----------------------------------------------------------------------
@query("group_median", sql=W + """
SELECT cat, count(*) AS n, round(median(num), 4) AS median_num,
       round(quantile_cont(num, 0.1), 4) AS p10_num
FROM o GROUP BY cat""")
def group_median(spark, sf):
    o = orders_view(spark, sf)
    n = stats.group_size_table(o, "cat", "n")
    q = stats.percentile_table(o, "cat", "num", [0.5, 0.1], {("num", 0.5): "_med", ("num", 0.1): "_p10"})
    return n.join(q, "cat").select("cat", "n", rnd("_med", 4).alias("median_num"), rnd("_p10", 4).alias("p10_num"))


# A5 / J2 / W1 -------------------------------------------------------------
@query("group_size_features", sql=W + """
, gs AS (SELECT grp, count(*) AS grp_size, count(DISTINCT cat) AS grp_n_cats FROM o GROUP BY grp)
SELECT o.id, gs.grp_size, CAST(gs.grp_size = 1 AS INTEGER) AS solo, gs.grp_n_cats
FROM o JOIN gs ON o.grp = gs.grp""")
def group_size_features(spark, sf):
    o = orders_view(spark, sf).select("id", "grp", "cat")
    out = stats.lookup(o, stats.group_size_table(o, "grp", "grp_size"), "grp")
    out = stats.lookup(out, stats.distinct_count_table(o, "grp", "cat", "grp_n_cats"), "grp")
    return out.select("id", "grp_size", flag(F.col("grp_size") == 1).alias("solo"), "grp_n_cats")


# A1 -----------------------------------------------------------------------
@query("group_label_stats", sql=W + """
SELECT grp, round(avg(label), 6) AS grp_mean, count(label) AS grp_count,
       CAST(sum(label) AS BIGINT) AS grp_sum,
       round(greatest(avg(label), 1 - avg(label)), 6) AS grp_agreement
FROM o WHERE is_train GROUP BY grp""")
def group_label_stats(spark, sf):
    tr, _ = train_test(spark, sf)
    t = stats.label_stats_table(tr, "grp", "label", "grp")
    return t.select("grp", rnd("grp_mean").alias("grp_mean"), "grp_count", "grp_sum",
                    rnd("grp_agreement").alias("grp_agreement"))


# J1 -----------------------------------------------------------------------
@query("lookup_join_default", sql=W + """
, st AS (SELECT grp, max(num) AS m FROM o WHERE is_train GROUP BY grp)
SELECT o.id, coalesce(st.m, (SELECT min(num) FROM o WHERE is_train)) AS grp_num_max,
       CAST(st.grp IS NOT NULL AS INTEGER) AS matched
FROM o LEFT JOIN st ON o.grp = st.grp WHERE NOT o.is_train""")
def lookup_join_default(spark, sf):
    tr, te = train_test(spark, sf)
    st = tr.groupBy("grp").agg(F.max("num").alias("_m"), F.lit(1).alias("_hit"))
    g = tr.agg(F.min("num").alias("_g"))
    out = stats.attach_global(stats.lookup(te.select("id", "grp"), st, "grp"), g)
    return out.select("id", F.coalesce("_m", "_g").alias("grp_num_max"),
                      F.coalesce("_hit", F.lit(0)).alias("matched"))


# J3 -----------------------------------------------------------------------
@query("semi_join_coverage", sql=W + """
SELECT t.id, CAST(EXISTS (SELECT 1 FROM o r WHERE r.is_train AND r.grp = t.grp) AS INTEGER) AS in_train
FROM o t WHERE NOT t.is_train""")
def semi_join_coverage(spark, sf):
    tr, te = train_test(spark, sf)
    keys = tr.select("grp").distinct().withColumn("_hit", F.lit(1))
    out = stats.lookup(te.select("id", "grp"), keys, "grp", {"_hit": 0})
    return out.select("id", F.col("_hit").alias("in_train"))


# J4 / U3 --------------------------------------------------------------------
@query("anti_join_unseen", sql=W + """
SELECT t.id, t.grp FROM o t WHERE NOT t.is_train
AND NOT EXISTS (SELECT 1 FROM o r WHERE r.is_train AND r.grp % 10 <> 3 AND r.grp = t.grp)""")
def anti_join_unseen(spark, sf):
    tr, te = train_test(spark, sf)
    known = tr.where("grp % 10 <> 3").select("grp")
    return te.select("id", "grp").join(known, "grp", "left_anti").select("id", "grp")


# J5 / U2 --------------------------------------------------------------------
@query("key_overlap", sql=W + """
, a AS (SELECT DISTINCT grp FROM o WHERE is_train), b AS (SELECT DISTINCT grp FROM o WHERE NOT is_train)
SELECT (SELECT count(*) FROM a) AS n_train_keys, (SELECT count(*) FROM b) AS n_test_keys,
       (SELECT count(*) FROM (SELECT grp FROM a INTERSECT SELECT grp FROM b)) AS n_shared,
       round(100.0 * avg(CASE WHEN t.grp IN (SELECT grp FROM a) THEN 1.0 ELSE 0.0 END), 4) AS pct_test_covered
FROM o t WHERE NOT t.is_train""")
def key_overlap(spark, sf):
    tr, te = train_test(spark, sf)
    a, b = tr.select("grp").distinct(), te.select("grp").distinct()
    shared = a.intersect(b)
    covered = stats.lookup(te.select("grp"), a.withColumn("_hit", F.lit(1.0)), "grp", {"_hit": 0.0})
    one = covered.agg(rnd(F.lit(100.0) * F.avg("_hit"), 4).alias("pct_test_covered"))
    counts = (a.agg(F.count(F.lit(1)).alias("n_train_keys"))
              .crossJoin(b.agg(F.count(F.lit(1)).alias("n_test_keys")))
              .crossJoin(shared.agg(F.count(F.lit(1)).alias("n_shared"))))
    return counts.crossJoin(one)


# A6 / E3 --------------------------------------------------------------------
@query("group_known_rate", sql=W + """
, tn AS (SELECT grp, count(label) AS n FROM o WHERE is_train GROUP BY grp)
, tot AS (SELECT grp, count(id) AS n FROM o GROUP BY grp)
SELECT t.id, CAST(tn.n IS NOT NULL AS INTEGER) AS known,
       round(least(greatest(coalesce(tn.n, 0) / coalesce(tot.n, 1), 0.0), 1.0), 6) AS known_rate
FROM o t LEFT JOIN tn ON t.grp = tn.grp LEFT JOIN tot ON t.grp = tot.grp
WHERE NOT t.is_train""")
def group_known_rate(spark, sf):
    tr, te = train_test(spark, sf)
    out = groups.group_known_rate(tr, te, "grp", "label", "id")
    return out.select("id", "known", rnd("known_rate").alias("known_rate"))


# W2 / E2 --------------------------------------------------------------------
@query("loo_target_mean", sql=W + """
, st AS (SELECT grp, sum(label) AS s, count(label) AS n FROM o WHERE is_train GROUP BY grp)
, x AS (SELECT o.id, coalesce(CASE WHEN st.n IS NOT NULL AND o.label IS NOT NULL
                              THEN greatest(st.s - o.label, 0) / greatest(st.n - 1, 1) END,
                              (SELECT avg(label) FROM o WHERE is_train)) AS m
        FROM o LEFT JOIN st ON o.grp = st.grp WHERE o.is_train)
SELECT id, round(m, 6) AS loo_mean, round(greatest(m, 1 - m), 6) AS loo_agreement FROM x""")
def loo_target_mean(spark, sf):
    tr, _ = train_test(spark, sf)
    out = groups.loo_target_mean(tr.select("id", "grp", "label"), "grp", "label", "loo")
    return out.select("id", rnd("loo_mean").alias("loo_mean"), rnd("loo_agreement").alias("loo_agreement"))


@query("test_group_mean", sql=W + """
, st AS (SELECT grp, avg(label) AS m FROM o WHERE is_train GROUP BY grp)
SELECT t.id, round(coalesce(st.m, (SELECT avg(label) FROM o WHERE is_train)), 6) AS loo_mean,
       round(coalesce(greatest(st.m, 1 - st.m), 0.5), 6) AS loo_agreement
FROM o t LEFT JOIN st ON t.grp = st.grp WHERE NOT t.is_train""")
def test_group_mean(spark, sf):
    tr, te = train_test(spark, sf)
    out = groups.test_group_mean(tr, te.select("id", "grp"), "grp", "label", "loo")
    return out.select("id", rnd("loo_mean").alias("loo_mean"), rnd("loo_agreement").alias("loo_agreement"))


@query("group_label_propagation", sql=W + """
, st AS (SELECT grp, sum(label) AS s, count(label) AS n, avg(label) AS m FROM o WHERE is_train GROUP BY grp)
, tot AS (SELECT grp, count(id) AS n FROM o GROUP BY grp)
, tr AS (SELECT o.id, o.is_train,
                coalesce(CASE WHEN st.n IS NOT NULL AND o.label IS NOT NULL
                         THEN greatest(st.s - o.label, 0) / greatest(st.n - 1, 1) END, 0.5) AS gm,
                CAST(st.n IS NOT NULL AS INTEGER) AS known, 1.0 AS known_rate
         FROM o LEFT JOIN st ON o.grp = st.grp WHERE o.is_train)
, te AS (SELECT o.id, o.is_train, coalesce(st.m, 0.5) AS gm,
                CAST(st.n IS NOT NULL AS INTEGER) AS known,
                least(greatest(coalesce(st.n, 0) / coalesce(tot.n, 1), 0.0), 1.0) AS known_rate,
                coalesce(greatest(st.m, 1 - st.m), 0.5) AS ga
         FROM o LEFT JOIN st ON o.grp = st.grp LEFT JOIN tot ON o.grp = tot.grp WHERE NOT o.is_train)
SELECT id, is_train, round(gm, 6) AS group_mean, round(greatest(gm, 1 - gm), 6) AS group_agreement,
       known, round(known_rate, 6) AS known_rate FROM tr
UNION ALL
SELECT id, is_train, round(gm, 6), round(ga, 6), known, round(known_rate, 6) FROM te""")
def group_label_propagation(spark, sf):
    tr, te = train_test(spark, sf)
    out = groups.group_label_propagation(tr.select("id", "grp", "label", "is_train"),
                                         te.select("id", "grp", "is_train"), "grp", "label", "id")
    return out.select("id", "is_train", rnd("group_mean").alias("group_mean"),
                      rnd("group_agreement").alias("group_agreement"), "known",
                      rnd("known_rate").alias("known_rate"))


# E1 -----------------------------------------------------------------------
_FOLD_SQL = f"CAST({sql_hash32('id', 42)} % 5 AS INTEGER)"


def _te_oof_sql(col: str) -> str:
    return f"""te_{col} AS (
  SELECT f.id, coalesce((t.s - fs.s + 10.0 * g.prior) / (t.n - fs.n + 10.0), g.prior) AS te
  FROM f CROSS JOIN g
  LEFT JOIN (SELECT {col} AS v, fold, sum(label) AS s, count(label) AS n FROM f
             WHERE {col} IS NOT NULL GROUP BY {col}, fold) fs ON f.{col} = fs.v AND f.fold = fs.fold
  LEFT JOIN (SELECT {col} AS v, sum(label) AS s, count(label) AS n FROM f
             WHERE {col} IS NOT NULL GROUP BY {col}) t ON f.{col} = t.v)"""


@query("target_encode_oof", sql=W + f"""
, f AS (SELECT id, cat, cat_n, label, {_FOLD_SQL} AS fold FROM o WHERE is_train)
, g AS (SELECT avg(label) AS prior FROM f)
, {_te_oof_sql('cat')}
, {_te_oof_sql('cat_n')}
SELECT f.id, f.fold, round(a.te, 6) AS te_cat, round(b.te, 6) AS te_cat_n
FROM f JOIN te_cat a ON f.id = a.id JOIN te_cat_n b ON f.id = b.id""")
def target_encode_oof(spark, sf):
    tr, _ = train_test(spark, sf)
    tr = folds.stratified_folds(tr.select("id", "cat", "cat_n", "label"), "id", 5, 42)
    out = encode.target_encode_oof(tr, ["cat", "cat_n"], "label", "fold", smoothing=10.0)
    return out.select("id", "fold", rnd("te_cat").alias("te_cat"), rnd("te_cat_n").alias("te_cat_n"))


def _te_full_sql(col: str) -> str:
    return f"""te_{col} AS (
  SELECT t.id, coalesce((st.s + 10.0 * g.prior) / (st.n + 10.0), g.prior) AS te
  FROM (SELECT * FROM o WHERE NOT is_train) t CROSS JOIN g
  LEFT JOIN (SELECT {col} AS v, sum(label) AS s, count(label) AS n FROM o WHERE is_train
             AND {col} IS NOT NULL GROUP BY {col}) st ON t.{col} = st.v)"""


@query("target_encode_full", sql=W + f"""
, g AS (SELECT avg(label) AS prior FROM o WHERE is_train)
, {_te_full_sql('cat')}
, {_te_full_sql('cat_n')}
SELECT a.id, round(a.te, 6) AS te_cat, round(b.te, 6) AS te_cat_n
FROM te_cat a JOIN te_cat_n b ON a.id = b.id""")
def target_encode_full(spark, sf):
    tr, te = train_test(spark, sf)
    out = encode.target_encode_full(tr, te.select("id", "cat", "cat_n"), ["cat", "cat_n"], "label")
    return out.select("id", rnd("te_cat").alias("te_cat"), rnd("te_cat_n").alias("te_cat_n"))


# E4 -----------------------------------------------------------------------
@query("ordinal_encode", sql=W + """
, v1 AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code
         FROM (SELECT DISTINCT coalesce(cat_n, '__MISSING__') AS v FROM o))
, v2 AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code
         FROM (SELECT DISTINCT coalesce(yr_n, '__MISSING__') AS v FROM o))
SELECT o.id, v1.code AS cat_n_code, v2.code AS yr_n_code
FROM o JOIN v1 ON coalesce(o.cat_n, '__MISSING__') = v1.v
       JOIN v2 ON coalesce(o.yr_n, '__MISSING__') = v2.v""")
def ordinal_encode(spark, sf):
    o = orders_view(spark, sf).select("id", "cat_n", "yr_n")
    out = encode.ordinal_encode(o, ["cat_n", "yr_n"])
    return out.select("id", "cat_n_code", "yr_n_code")


# B1 -----------------------------------------------------------------------
@query("equal_width_bucket", sql=W + """
, r AS (SELECT min(num_n) AS lo, max(num_n) AS hi FROM o)
SELECT id, CAST(CASE WHEN num_n IS NULL THEN -1 WHEN hi = lo THEN 0 ELSE
         least(greatest(CAST(ceil((num_n - lo) / ((hi - lo) / 10.0)) AS INTEGER) - 1, 0), 9) END AS INTEGER)
       AS bucket
FROM o, r""")
def equal_width_bucket(spark, sf):
    o = orders_view(spark, sf).select("id", "num_n")
    r = o.agg(F.min("num_n").alias("_lo"), F.max("num_n").alias("_hi"))
    out = stats.attach_global(o, r)
    return out.select("id", equal_width_code("num_n", F.col("_lo"), F.col("_hi"), 10).alias("bucket"))


# B3 -----------------------------------------------------------------------
_Q6 = [i / 6 for i in range(7)]


@query("quantile_bucket", sql=W + f"""
, e AS (SELECT list_sort(list_distinct(quantile_cont(num_n, [{', '.join(repr(q) for q in _Q6)}]))) AS edges FROM o)
SELECT id, CASE WHEN num_n IS NULL THEN NULL ELSE
       CAST(greatest(len(list_filter(edges, lambda x: x < num_n)) - 1, 0) AS INTEGER) END AS bucket
FROM o, e""")
def quantile_bucket(spark, sf):
    o = orders_view(spark, sf).select("id", "num_n")
    q = stats.percentile_table(o, [], "num_n", _Q6)
    e = q.select(F.array_distinct(F.array(*[F.col(f"num_n_q{j}") for j in range(len(_Q6))])).alias("_edges"))
    out = stats.attach_global(o, e)
    return out.select("id", rank_in_edges("num_n", F.col("_edges")).cast("int").alias("bucket"))


# D1 / D2 ------------------------------------------------------------------
@query("stratified_folds", sql=W + f"""
SELECT id, label, {_FOLD_SQL} AS fold FROM o WHERE is_train""")
def stratified_folds(spark, sf):
    tr, _ = train_test(spark, sf)
    return folds.stratified_folds(tr.select("id", "label"), "id", 5, 42)


@query("stratified_folds_exact", sql=W + f"""
SELECT id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY {sql_hash32('id', 42)}, id) - 1) % 5
       AS INTEGER) AS fold
FROM o WHERE is_train""")
def stratified_folds_exact(spark, sf):
    tr, _ = train_test(spark, sf)
    return folds.exact_stratified_folds(tr.select("id", "label"), "id", "label", 5, 42)


# The five repeat seeds of the source configuration.
REPEAT_SEEDS = [42, 2024, 7, 2025, 88]


@query("repeated_folds", sql=W + f"""
SELECT id, seed, CAST(CAST(('0x' || substr(md5(CAST(id AS VARCHAR) || ':' || CAST(seed AS VARCHAR)), 1, 8))
       AS UBIGINT) % 5 AS INTEGER) AS fold
FROM o, (SELECT unnest([{', '.join(str(s) for s in REPEAT_SEEDS)}]) AS seed) s WHERE is_train""")
def repeated_folds(spark, sf):
    tr, _ = train_test(spark, sf)
    return folds.repeated_folds(tr.select("id"), "id", REPEAT_SEEDS, 5).select("id", "seed", "fold")


# F3 / F4 / F5 -------------------------------------------------------------
_RULE = "(cat = '5-LOW' AND num < 50000)"


@query("rule_accuracy", sql=W + f"""
SELECT 'R1' AS rule, count(*) AS n, round(avg(CASE WHEN label = 1 THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       1 AS label
FROM o WHERE is_train AND {_RULE} HAVING count(*) > 0""")
def rule_accuracy(spark, sf):
    tr, _ = train_test(spark, sf)
    hit = tr.where(F.expr(_RULE))
    out = hit.agg(F.count(F.lit(1)).alias("n"),
                  rnd(F.avg((F.col("label") == 1).cast("double"))).alias("accuracy"))
    return out.where(F.col("n") > 0).select(F.lit("R1").alias("rule"), "n", "accuracy",
                                            F.lit(1).alias("label"))


@query("locked_predictions", sql=W + f"""
SELECT id, CASE WHEN {_RULE} THEN 1 END AS locked FROM o WHERE NOT is_train""")
def locked_predictions(spark, sf):
    _, te = train_test(spark, sf)
    return te.select("id", F.when(F.expr(_RULE), F.lit(1)).alias("locked"))


@query("group_rule_locks", sql=W + """
, st AS (SELECT grp, avg(label) AS m, count(label) AS n FROM o WHERE is_train GROUP BY grp)
SELECT t.id, CASE WHEN st.n > 1 AND st.m >= 0.95 THEN 1
                  WHEN st.n > 1 AND st.m <= 0.05 THEN 0 END AS group_lock
FROM o t LEFT JOIN st ON t.grp = st.grp WHERE NOT t.is_train""")
def group_rule_locks(spark, sf):
    tr, te = train_test(spark, sf)
    st = tr.groupBy("grp").agg(F.avg("label").alias("_m"), F.count("label").alias("_n"))
    out = stats.lookup(te.select("id", "grp"), st, "grp")
    lock = (F.when((F.col("_n") > 1) & (F.col("_m") >= 0.95), F.lit(1))
             .when((F.col("_n") > 1) & (F.col("_m") <= 0.05), F.lit(0)))
    return out.select("id", lock.alias("group_lock"))


# A20 ----------------------------------------------------------------------
@query("group_signal_share", sql=W + """
, st AS (SELECT grp, avg(label) AS m FROM o WHERE is_train GROUP BY grp)
, x AS (SELECT coalesce(greatest(st.m, 1 - st.m), 0.5) AS ga, st.m IS NOT NULL AS known
        FROM o t LEFT JOIN st ON t.grp = st.grp WHERE NOT t.is_train)
SELECT round(avg(CASE WHEN ga >= 0.9 AND known THEN 1.0 ELSE 0.0 END), 6) AS strong_share,
       round(avg(ga), 6) AS mean_agreement FROM x""")
def group_signal_share(spark, sf):
    tr, te = train_test(spark, sf)
    x = groups.test_group_mean(tr, te.select("id", "grp"), "grp", "label", "g", prior=0.5)
    x = groups.group_known_rate(tr, x, "grp", "label", "id")
    return x.agg(rnd(F.avg(((F.col("g_agreement") >= 0.9) & (F.col("known") == 1)).cast("double")))
                 .alias("strong_share"), rnd(F.avg("g_agreement")).alias("mean_agreement"))


# O5 -----------------------------------------------------------------------
@query("deterministic_sample", sql=W + f"""
SELECT id, {sql_hash32('id', 42)} AS h FROM o ORDER BY h, id LIMIT 1000""")
def deterministic_sample(spark, sf):
    o = orders_view(spark, sf).select("id").withColumn("h", hash32("id", seed=42))
    return o.orderBy("h", "id").limit(1000)


# O3 -----------------------------------------------------------------------
@query("quantile_cutoff", sql=W + """
SELECT id, num FROM o WHERE num < (SELECT quantile_cont(num, 0.1) FROM o)""")
def quantile_cutoff(spark, sf):
    o = orders_view(spark, sf).select("id", "num")
    q = stats.percentile_table(o, [], "num", [0.1], {("num", 0.1): "_q"})
    return stats.attach_global(o, q).where(F.col("num") < F.col("_q")).select("id", "num")


# P16 / P17 ----------------------------------------------------------------
@query("feature_matrix", sql=W + """
, gs AS (SELECT grp, count(*) AS n FROM o GROUP BY grp)
, v AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT cat AS v FROM o))
SELECT o.id, o.is_train, o.label, CAST(o.num AS DOUBLE) AS f_num, CAST(v.code AS DOUBLE) AS f_cat,
       CAST(gs.n AS DOUBLE) AS f_grp_size, round(ln(1 + o.num), 6) AS f_log_num
FROM o JOIN gs ON o.grp = gs.grp JOIN v ON o.cat = v.v""")
def feature_matrix(spark, sf):
    o = orders_view(spark, sf).select("id", "grp", "cat", "num", "is_train", "label")
    o = stats.lookup(o, stats.group_size_table(o, "grp", "_gs"), "grp")
    o = encode.ordinal_encode(o, ["cat"])
    return o.select("id", "is_train", "label", F.col("num").cast("double").alias("f_num"),
                    F.col("cat_code").cast("double").alias("f_cat"),
                    F.col("_gs").cast("double").alias("f_grp_size"),
                    rnd(F.log1p("num")).alias("f_log_num"))


# A21 ----------------------------------------------------------------------
@query("solo_group_split", sql=W + """
, gs AS (SELECT grp, count(*) AS n FROM o GROUP BY grp)
SELECT CAST(count_if(gs.n = 1) AS BIGINT) AS n_solo, CAST(count_if(gs.n > 1) AS BIGINT) AS n_in_group
FROM o JOIN gs ON o.grp = gs.grp""")
def solo_group_split(spark, sf):
    o = orders_view(spark, sf).select("id", "grp")
    o = stats.lookup(o, stats.group_size_table(o, "grp", "_n"), "grp")
    return o.agg(F.count_if(F.col("_n") == 1).alias("n_solo"), F.count_if(F.col("_n") > 1).alias("n_in_group"))


# J1 / J2 with a salted join ------------------------------------------------
@query("lookup_join_salted", sql=W + """
, gs AS (SELECT grp, count(*) AS n FROM o GROUP BY grp)
SELECT o.id, gs.n AS grp_size FROM o LEFT JOIN gs ON o.grp = gs.grp""")
def lookup_join_salted(spark, sf):
    """Group sizes joined back with the salted lookup (each key spread over 8
    join tasks), the path for hot keys without AQE's skew split."""
    o = orders_view(spark, sf).select("id", "grp")
    return stats.lookup(o, stats.group_size_table(o, "grp", "grp_size"), "grp", salt=8).select("id", "grp_size")


# A7, every value and the missing ones ----------------------------------------
_STATUS = ["F", "O", "P", "Missing"]


@query("pivot_mean_all", sql=W + " SELECT cat, " + ", ".join(
    f"round(avg(CASE WHEN coalesce(cat2_n, 'Missing') = '{v}' THEN num END), 3) AS {v}" for v in _STATUS) + """
FROM o GROUP BY cat""")
def pivot_mean_all(spark, sf):
    o = orders_view(spark, sf).select("cat", "cat2_n", "num")
    p = profile.pivot_mean(o, "cat", "cat2_n", None, "num", missing="Missing")
    return p.select("cat", *[rnd(c, 3).alias(c) for c in sorted(set(p.columns) - {"cat"})])
