"""Queries over part / customer (string parsing, crosses, bands), lineitem /
events (profiles, crosstabs, pivots, top-k, running best) and documents
(TF-IDF terms)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import (AGE_BAND_EDGES, AGE_BAND_LABELS, EDA_AGE_EDGES, bool_text,
                                 category_cross, flag, parity, parse_delimited_field,
                                 right_closed_band, slugify, split_composite_key, surname_extract)
from ..operators import encode, profile
from ..sources.tables import read_table
from .base import query, rnd

# -- part / customer ------------------------------------------------------------
# Missing values are injected by key rules, the same on both sides.

_PART_NULLS = """p AS (SELECT p_partkey, p_size, p_retailprice, p_brand,
  CASE WHEN p_partkey % 11 = 3 THEN NULL ELSE p_name END AS p_name,
  CASE WHEN p_partkey % 9 = 4 THEN NULL ELSE p_type END AS p_type,
  CASE WHEN p_partkey % 9 = 4 THEN NULL ELSE p_size END AS size_n,
  CASE WHEN p_partkey % 9 = 4 THEN NULL
       WHEN p_partkey % 13 = 5 THEN p_type || '/x/' || p_brand
       ELSE p_type || '/' || CAST(p_size AS VARCHAR) || '/' || p_brand END AS cabin
  FROM part)"""


def _part(spark, sf):
    p = read_table(spark, sf, "part")
    k = F.col("p_partkey")
    cabin = (F.when(k % 9 == 4, F.lit(None))
              .when(k % 13 == 5, F.concat(F.col("p_type"), F.lit("/x/"), F.col("p_brand")))
              .otherwise(F.concat_ws("/", F.col("p_type"), F.col("p_size").cast("string"), F.col("p_brand"))))
    return p.select("p_partkey", "p_size", "p_retailprice", "p_brand",
                    F.when(k % 11 == 3, F.lit(None)).otherwise(F.col("p_name")).alias("p_name"),
                    F.when(k % 9 == 4, F.lit(None)).otherwise(F.col("p_type")).alias("p_type"),
                    F.when(k % 9 == 4, F.lit(None)).otherwise(F.col("p_size")).alias("size_n"),
                    cabin.alias("cabin"))


# P1 -------------------------------------------------------------------------
@query("split_composite_key", sql="""
SELECT 'customer' AS source, c_custkey AS key, TRY_CAST(split_part(c_name, '#', 1) AS BIGINT) AS key_group,
       TRY_CAST(split_part(c_name, '#', 2) AS BIGINT) AS key_member FROM customer
UNION ALL
SELECT 'part', p_partkey, TRY_CAST(split_part(p_brand, '#', 1) AS BIGINT),
       TRY_CAST(split_part(p_brand, '#', 2) AS BIGINT) FROM part
UNION ALL
SELECT 'order', o_orderkey, o_custkey, o_orderkey FROM orders""")
def split_composite_key_q(spark, sf):
    c = read_table(spark, sf, "customer").select(F.lit("customer").alias("source"),
                                                  F.col("c_custkey").alias("key"), F.col("c_name").alias("_k"))
    p = read_table(spark, sf, "part").select(F.lit("part").alias("source"),
                                              F.col("p_partkey").alias("key"), F.col("p_brand").alias("_k"))
    o = read_table(spark, sf, "orders").select(F.lit("order").alias("source"), F.col("o_orderkey").alias("key"),
                                               F.concat_ws("#", "o_custkey", "o_orderkey").alias("_k"))
    g, m = split_composite_key("_k", "#")
    return c.unionByName(p).unionByName(o).select("source", "key", g.alias("key_group"), m.alias("key_member"))


# P2 -------------------------------------------------------------------------
@query("parse_delimited_field", sql="WITH " + _PART_NULLS + """
, s AS (SELECT p_partkey, coalesce(cabin, 'U/9999/U') AS c FROM p)
SELECT p_partkey, split_part(c, '/', 1) AS deck, TRY_CAST(split_part(c, '/', 2) AS DOUBLE) AS num,
       split_part(c, '/', 3) AS side FROM s""")
def parse_delimited_field_q(spark, sf):
    p = _part(spark, sf)
    d, n, s = parse_delimited_field("cabin", "/", "U/9999/U")
    return p.select("p_partkey", d.alias("deck"), n.alias("num"), s.alias("side"))


# P3 -------------------------------------------------------------------------
@query("surname_extract", sql="WITH " + _PART_NULLS + """
SELECT p_partkey, CASE WHEN strpos(coalesce(p_name, 'Unknown Unknown'), ' ') = 0 THEN 'Unknown'
       ELSE substr(coalesce(p_name, 'Unknown Unknown'), strpos(coalesce(p_name, 'Unknown Unknown'), ' ') + 1)
       END AS surname FROM p""")
def surname_extract_q(spark, sf):
    p = _part(spark, sf)
    return p.select("p_partkey", surname_extract("p_name").alias("surname"))


# P13 / P14 -----------------------------------------------------------------
@query("category_cross", sql="WITH " + _PART_NULLS + """
SELECT p_partkey, coalesce(p_type, 'nan') || '_' || coalesce(p_brand, 'nan') AS type_brand,
       CASE WHEN size_n > 25 THEN 'True' WHEN size_n <= 25 THEN 'False' ELSE 'False' END AS big_text
FROM p""")
def category_cross_q(spark, sf):
    p = _part(spark, sf)
    return p.select("p_partkey", category_cross("p_type", "p_brand").alias("type_brand"),
                    bool_text(F.col("size_n") > 25).alias("big_text"))


# P15 ------------------------------------------------------------------------
@query("parity_flag", sql="WITH " + _PART_NULLS + """
SELECT p_partkey, coalesce(CAST(size_n % 2 AS INTEGER), -1) AS parity FROM p""")
def parity_flag(spark, sf):
    p = _part(spark, sf)
    return p.select("p_partkey", parity("size_n").alias("parity"))


# P10 ------------------------------------------------------------------------
@query("range_flags", sql="WITH " + _PART_NULLS + """
, a AS (SELECT p_partkey, size_n * 1.5 AS age FROM p)
SELECT p_partkey, CAST(coalesce(age < 13, false) AS INTEGER) AS is_child,
       CAST(coalesce(age >= 13 AND age < 18, false) AS INTEGER) AS is_teen,
       CAST(coalesce(age >= 60, false) AS INTEGER) AS is_senior FROM a""")
def range_flags(spark, sf):
    p = _part(spark, sf)
    age = F.col("size_n") * 1.5
    return p.select("p_partkey", flag(age < 13).alias("is_child"),
                    flag((age >= 13) & (age < 18)).alias("is_teen"), flag(age >= 60).alias("is_senior"))


# B2 -------------------------------------------------------------------------
def _band_sql(x, edges, labels, outside):
    whens = " ".join(f"WHEN {x} > {lo} AND {x} <= {hi} THEN '{lab}'"
                     for lo, hi, lab in zip(edges[:-1], edges[1:], labels))
    return f"CASE {whens} ELSE '{outside}' END"


@query("age_band", sql="WITH " + _PART_NULLS + f"""
SELECT p_partkey, {_band_sql('size_n * 2.5', AGE_BAND_EDGES, AGE_BAND_LABELS, 'nan')} AS age_band FROM p""")
def age_band(spark, sf):
    p = _part(spark, sf)
    return p.select("p_partkey", right_closed_band(F.col("size_n") * 2.5, AGE_BAND_EDGES,
                                                   AGE_BAND_LABELS).alias("age_band"))


# B4 -------------------------------------------------------------------------
_EDA_LABELS = [f"({lo},{hi}]" for lo, hi in zip(EDA_AGE_EDGES[:-1], EDA_AGE_EDGES[1:])]


@query("rate_by_age_band", sql="WITH " + _PART_NULLS + f"""
, b AS (SELECT {_band_sql('size_n * 2.5', EDA_AGE_EDGES, _EDA_LABELS, 'outside')} AS band,
               CAST(p_retailprice > 1500 AS INTEGER) AS t FROM p)
SELECT band, round(avg(CAST(t AS DOUBLE)), 6) AS rate, count(*) AS n FROM b WHERE band <> 'outside' GROUP BY band""")
def rate_by_age_band(spark, sf):
    p = _part(spark, sf)
    b = p.select(right_closed_band(F.col("size_n") * 2.5, EDA_AGE_EDGES, _EDA_LABELS, "outside").alias("band"),
                 (F.col("p_retailprice") > 1500).cast("int").alias("t"))
    r = profile.rate_by_category(b.where(F.col("band") != "outside"), "band", "t")
    return r.select("band", rnd("rate").alias("rate"), "n")


# slug -----------------------------------------------------------------------
@query("slugify", sql="""
SELECT p_partkey, CASE WHEN s = '' OR s IS NULL THEN 'item' ELSE s END AS slug
FROM (SELECT p_partkey, regexp_replace(regexp_replace(lower(p_type || ' ' || p_name || ' (' || p_brand || ')'),
      '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS s FROM part)""")
def slugify_q(spark, sf):
    p = read_table(spark, sf, "part")
    txt = F.concat(F.col("p_type"), F.lit(" "), F.col("p_name"), F.lit(" ("), F.col("p_brand"), F.lit(")"))
    return p.select("p_partkey", slugify(txt).alias("slug"))


# -- lineitem / events profiles ------------------------------------------------

_LI_NULLS = """li AS (SELECT l_orderkey, l_partkey, l_returnflag, l_extendedprice,
  CASE WHEN l_orderkey % 17 = 1 THEN NULL ELSE l_discount END AS l_discount,
  CASE WHEN l_orderkey % 23 = 2 THEN NULL ELSE l_tax END AS l_tax,
  CASE WHEN l_orderkey % 29 = 3 THEN NULL ELSE l_quantity END AS l_quantity,
  CASE WHEN l_orderkey % 31 = 4 THEN NULL ELSE l_linestatus END AS l_linestatus
  FROM lineitem)"""


def _lineitem(spark, sf):
    li = read_table(spark, sf, "lineitem")
    k = F.col("l_orderkey")
    return li.select("l_orderkey", "l_partkey", "l_returnflag", "l_extendedprice",
                     F.when(k % 17 == 1, F.lit(None)).otherwise(F.col("l_discount")).alias("l_discount"),
                     F.when(k % 23 == 2, F.lit(None)).otherwise(F.col("l_tax")).alias("l_tax"),
                     F.when(k % 29 == 3, F.lit(None)).otherwise(F.col("l_quantity")).alias("l_quantity"),
                     F.when(k % 31 == 4, F.lit(None)).otherwise(F.col("l_linestatus")).alias("l_linestatus"))


# A9 / A21 / O1 / O4 --------------------------------------------------------
@query("value_counts", sql="""
SELECT l_returnflag, count(*) AS n, round(count(*) / (SELECT count(*) FROM lineitem), 6) AS share
FROM lineitem GROUP BY l_returnflag""")
def value_counts(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_returnflag")
    v = profile.value_counts(li, "l_returnflag")
    return v.select("l_returnflag", "n", rnd("share").alias("share"))


# O4 -------------------------------------------------------------------------
@query("distinct_sorted_values", sql="SELECT DISTINCT l_shipdate AS value FROM lineitem WHERE l_shipdate IS NOT NULL ORDER BY 1")
def distinct_sorted_values(spark, sf):
    return profile.distinct_sorted(read_table(spark, sf, "lineitem"), "l_shipdate")


# A10 ------------------------------------------------------------------------
_NR_COLS = ["l_discount", "l_tax", "l_quantity", "l_linestatus", "l_returnflag"]


@query("null_rates", sql="WITH " + _LI_NULLS + """
SELECT * FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS column, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_rate FROM li"
    for c in _NR_COLS) + ") WHERE null_rate > 0")
def null_rates(spark, sf):
    n = profile.null_rates(_lineitem(spark, sf), _NR_COLS)
    return n.select("column", rnd("null_rate").alias("null_rate"))


# A11 ------------------------------------------------------------------------
_DESC_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("describe_numeric", sql="WITH " + _LI_NULLS + " " + " UNION ALL ".join(
    f"""SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
       round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(median({c}), 4) AS q50,
       round(quantile_cont({c}, 0.75), 4) AS q75, round(max({c}), 4) AS max FROM li""" for c in _DESC_COLS))
def describe_numeric(spark, sf):
    d = profile.describe_numeric(_lineitem(spark, sf), _DESC_COLS)
    return d.select("column", "count", *[rnd(c, 4).alias(c) for c in ["mean", "std", "min", "q25", "q50", "q75", "max"]])


# A12 ------------------------------------------------------------------------
@query("correlation_matrix", sql="WITH " + _LI_NULLS + " " + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM li"
    for i, a in enumerate(_DESC_COLS) for b in _DESC_COLS[: i + 1]))
def correlation_matrix(spark, sf):
    c = profile.correlation_matrix(_lineitem(spark, sf), _DESC_COLS)
    return c.select("col_a", "col_b", rnd("corr").alias("corr"))


# A13 ------------------------------------------------------------------------
@query("class_histogram", sql="""
WITH r AS (SELECT l_returnflag, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem GROUP BY 1)
SELECT l.l_returnflag, CAST(CASE WHEN r.hi = r.lo THEN 0 ELSE
         least(floor((l.l_extendedprice - r.lo) / ((r.hi - r.lo) / 40)), 39) END AS INTEGER) AS bin,
       count(*) AS n, min(r.lo) AS lo, min(r.hi) AS hi
FROM lineitem l JOIN r ON l.l_returnflag = r.l_returnflag GROUP BY ALL""")
def class_histogram(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    return profile.class_histogram(li, "l_extendedprice", "l_returnflag", 40)


# A8 -------------------------------------------------------------------------
@query("crosstab_pct", sql="WITH " + _LI_NULLS + """
, c AS (SELECT coalesce(l_returnflag, 'Missing') AS l_returnflag, coalesce(l_linestatus, 'Missing') AS l_linestatus,
               count(*) AS n FROM li GROUP BY ALL)
SELECT l_returnflag, l_linestatus, n, round(n * 100.0 / sum(n) OVER (PARTITION BY l_returnflag), 4) AS row_pct FROM c""")
def crosstab_pct(spark, sf):
    c = profile.crosstab_pct(_lineitem(spark, sf), "l_returnflag", "l_linestatus")
    return c.select("l_returnflag", "l_linestatus", "n", rnd("row_pct", 4).alias("row_pct"))


# A7 -------------------------------------------------------------------------
@query("pivot_mean", sql="""
SELECT l_returnflag, round(avg(CASE WHEN l_linestatus = 'F' THEN l_discount END), 6) AS F,
       round(avg(CASE WHEN l_linestatus = 'O' THEN l_discount END), 6) AS O
FROM lineitem GROUP BY l_returnflag""")
def pivot_mean(spark, sf):
    li = read_table(spark, sf, "lineitem")
    p = profile.pivot_mean(li, "l_returnflag", "l_linestatus", ["F", "O"], "l_discount")
    return p.select("l_returnflag", rnd("F").alias("F"), rnd("O").alias("O"))


# A15 ------------------------------------------------------------------------
@query("rate_by_category", sql="""
SELECT event_type, round(avg(CASE WHEN value > 250 THEN 1.0 ELSE 0.0 END), 6) AS rate, count(*) AS n
FROM events GROUP BY event_type""")
def rate_by_category(spark, sf):
    ev = read_table(spark, sf, "events").select("event_type", (F.col("value") > 250).cast("int").alias("t"))
    r = profile.rate_by_category(ev, "event_type", "t")
    return r.select("event_type", rnd("rate").alias("rate"), "n")


# O2 -------------------------------------------------------------------------
@query("top_routes", sql="""
SELECT l_partkey, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n
FROM lineitem GROUP BY l_partkey ORDER BY sum(l_extendedprice * (1 - l_discount)) DESC, l_partkey LIMIT 20""")
def top_routes(spark, sf):
    li = read_table(spark, sf, "lineitem")
    agg = li.groupBy("l_partkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("_rev"),
                                      F.count(F.lit(1)).alias("n"))
    top = profile.top_n(agg, [F.desc("_rev"), F.asc("l_partkey")], 20)
    return top.select("l_partkey", rnd("_rev", 2).alias("revenue"), "n")


# W3 -------------------------------------------------------------------------
@query("running_best", sql="""
SELECT event_id, user_id, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_best
FROM events""")
def running_best(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    ev = ev.withColumn("hour", F.date_trunc("hour", "ts"))
    r = profile.running_best(ev, "user_id", ["ts", "event_id"], "value", chunk_col="hour")
    return r.select("event_id", "user_id", "running_best")


# -- documents ---------------------------------------------------------------

@query("tfidf_terms", sql="""
WITH toks AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS term FROM documents)
, tf AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY ALL)
, voc AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf
          FROM tf GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 1000)
, w AS (SELECT tf.doc_id, tf.term, tf.tf, voc.idf, tf.tf * voc.idf AS raw FROM tf JOIN voc ON tf.term = voc.term)
SELECT doc_id, term, tf, round(idf, 6) AS idf,
       round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""")
def tfidf_terms(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    t = encode.tfidf_terms(d, "doc_id", "text", 1000)
    return t.select("doc_id", "term", "tf", rnd("idf").alias("idf"), rnd("weight").alias("weight"))


# A4 / A11, distributed path -----------------------------------------------
@query("percentiles_distributed", sql="""
SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 4) AS q25,
       round(median(l_extendedprice), 4) AS q50, round(quantile_cont(l_extendedprice, 0.75), 4) AS q75,
       round(quantile_cont(l_extendedprice, 0.99), 4) AS q99
FROM lineitem GROUP BY l_returnflag""")
def percentiles_distributed(spark, sf):
    """Exact quartiles over few large groups, with fewer chunks than the default."""
    from ..operators.stats import percentile_table
    li = read_table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    ps = [0.25, 0.5, 0.75, 0.99]
    names = {("l_extendedprice", p): n for p, n in zip(ps, ["q25", "q50", "q75", "q99"])}
    t = percentile_table(li, "l_returnflag", "l_extendedprice", ps, names, n_chunks=16)
    return t.select("l_returnflag", *[rnd(c, 4).alias(c) for c in ["q25", "q50", "q75", "q99"]])
