"""Stage tables, checked CSV input, and member features of groups."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.groups import member_features
from ..session import ensure_checkpoint_dir
from ..sources.tables import read_csv_checked, read_table, replace_partitions
from .base import S_CTE, orders_view, query, rnd, score, sql_score


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# S4 -----------------------------------------------------------------------
@query("stage_runs", sql="WITH " + S_CTE + f"""
SELECT id, 0 AS run, round({sql_score('id', 'run0')}, 6) AS prob FROM s
UNION ALL SELECT id, 1, round({sql_score('id', 'run1-again')}, 6) FROM s WHERE is_train""")
def stage_runs(spark, sf):
    """Two runs written as partitions of a stage table, the second replaced by a later
    one with fewer rows, both read back."""
    o, path = orders_view(spark, sf), _folder(spark, "runs")

    def run(rows, number, tag):
        return rows.select("id", rnd(score("id", tag)).alias("prob"), F.lit(number).alias("run"))
    replace_partitions(run(o, 0, "run0").unionByName(run(o, 1, "run1")), path, ["run"])
    return replace_partitions(run(o.where("is_train"), 1, "run1-again"), path, ["run"]).select("id", "run", "prob")


# S1 / S2 ------------------------------------------------------------------
@query("csv_round_trip", sql="""
SELECT c_mktsegment AS segment, c_custkey % 50 = 7 AS bad, count(*) AS n,
  round(sum(CASE WHEN c_custkey % 50 <> 7 THEN c_acctbal END), 2) AS balance,
  CAST(sum(CASE WHEN c_custkey % 50 = 7 THEN 1 + length(CAST(c_custkey AS VARCHAR)) END) AS BIGINT) AS bad_key_chars
FROM customer GROUP BY ALL""")
def csv_round_trip(spark, sf):
    """Customers written as CSV with a header, some keys spoilt, and read with a declared
    schema: rows that do not fit are counted, not lost."""
    path = _folder(spark, "csv")
    key = F.when(F.col("c_custkey") % 50 == 7, F.concat(F.lit("x"), F.col("c_custkey"))).otherwise(F.col("c_custkey").cast("string"))
    (read_table(spark, sf, "customer").select("c_mktsegment", "c_acctbal", key.alias("c_custkey"))
     .write.option("header", "true").csv(path))
    rows = read_csv_checked(spark, path, "c_mktsegment string, c_acctbal double, c_custkey bigint")
    bad = F.col("_bad").isNotNull()
    return (rows.groupBy(F.col("c_mktsegment").alias("segment"), bad.alias("bad"))
            .agg(F.count("*").alias("n"), rnd(F.sum(F.when(~bad, F.col("c_acctbal"))), 2).alias("balance"),
                 F.sum(F.length(F.regexp_extract("_bad", "x[0-9]+", 0))).alias("bad_key_chars")))


# members of a group -------------------------------------------------------
@query("member_features", sql="""
SELECT o_orderkey AS id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS member_rank,
  count(*) OVER g AS group_size, round(avg(o_totalprice) OVER g, 6) AS group_mean,
  round(stddev_pop(o_totalprice) OVER g, 6) AS group_std, round(max(o_totalprice) OVER g - min(o_totalprice) OVER g, 6) AS group_range,
  CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1 AS INTEGER) AS is_first,
  CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1 AS INTEGER) AS is_last
FROM orders WINDOW g AS (PARTITION BY o_custkey)""")
def member_features_query(spark, sf):
    """Orders of a customer by date."""
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    out = member_features(o, "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return out.select(F.col("o_orderkey").alias("id"), "member_rank", "group_size", rnd("group_mean", 6).alias("group_mean"),
                      rnd("group_std", 6).alias("group_std"), rnd("group_range", 6).alias("group_range"), "is_first", "is_last")
