"""Base views shared by the Spark queries and their SQL oracles.

Each view exists twice, written the same way: a DataFrame builder (Spark side)
and a SQL CTE (DuckDB side, same tables registered as views). The test tables
have no NULLs, so the views inject them with a key rule that both sides share.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import uniform
from ..sources.tables import read_table

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    """Register a Spark query (spark, sf_dir) -> DataFrame with its oracle SQL."""
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def rnd(c, digits: int = 6):
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def dlit(x: float) -> str:
    """A double literal parsed the same way as the Python float."""
    return f"CAST('{x!r}' AS DOUBLE)"


def sql_hash32(expr: str, seed) -> str:
    tag = f"CAST({expr} AS VARCHAR) || ':{seed}'" if seed is not None else expr
    return f"CAST(CAST(('0x' || substr(md5({tag}), 1, 8)) AS UBIGINT) AS BIGINT)"


def sql_uniform(expr: str, seed) -> str:
    return f"(CAST({sql_hash32(expr, seed)} AS DOUBLE) / CAST(4294967296 AS DOUBLE))"


def sql_uniform_open(expr: str, seed) -> str:
    return f"((CAST({sql_hash32(expr, seed)} AS DOUBLE) + 0.5) / CAST(4294967296 AS DOUBLE))"


def sql_normal(expr: str, seed) -> str:
    u1 = sql_uniform_open(expr, f"{seed}:a")
    u2 = sql_uniform_open(expr, f"{seed}:b")
    return f"(sqrt(-2.0 * ln({u1})) * cos({dlit(2.0 * 3.141592653589793)} * {u2}))"


# -- O: orders as an entity table ---------------------------------------------
# grp = customer, cat = priority, y = status 'F', train = key % 3 <> 0,
# NULLs injected by key rules (same in both engines).

def orders_view(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders")
    k = F.col("o_orderkey")
    y = (F.col("o_orderstatus") == "F").cast("int")
    is_train = (k % 3) != 0
    return o.select(
        k.alias("id"), F.col("o_custkey").alias("grp"),
        F.col("o_orderpriority").alias("cat"), F.col("o_orderstatus").alias("cat2"),
        F.col("o_totalprice").alias("num"), y.alias("y"), is_train.alias("is_train"),
        F.when(is_train, y).alias("label"),
        F.when(k % 7 == 3, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("cat_n"),
        F.when(k % 7 == 3, F.lit(None)).otherwise(F.col("o_totalprice")).alias("num_n"),
        F.when(k % 11 == 5, F.lit(None)).otherwise(F.col("o_orderstatus")).alias("cat2_n"),
        F.when(k % 13 == 6, F.lit(None)).otherwise(
            F.year("o_orderdate").cast("string")).alias("yr_n"),
    )


O_CTE = """o AS (
  SELECT o_orderkey AS id, o_custkey AS grp, o_orderpriority AS cat, o_orderstatus AS cat2,
         o_totalprice AS num, CAST(o_orderstatus = 'F' AS INTEGER) AS y,
         (o_orderkey % 3 <> 0) AS is_train,
         CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderstatus = 'F' AS INTEGER) END AS label,
         CASE WHEN o_orderkey % 7 = 3 THEN NULL ELSE o_orderpriority END AS cat_n,
         CASE WHEN o_orderkey % 7 = 3 THEN NULL ELSE o_totalprice END AS num_n,
         CASE WHEN o_orderkey % 11 = 5 THEN NULL ELSE o_orderstatus END AS cat2_n,
         CASE WHEN o_orderkey % 13 = 6 THEN NULL ELSE CAST(year(o_orderdate) AS VARCHAR) END AS yr_n
  FROM orders)"""


def train_test(spark: SparkSession, sf: str):
    o = orders_view(spark, sf)
    return o.where("is_train"), o.where("NOT is_train")


# -- S: O plus stand-in model probabilities -----------------------------------
# p_m = 0.7 * H(id, m) + 0.3 * y: informative but imperfect scores with exact
# SQL twins, so every post-model operator has an exact oracle.

MODELS = ["m1", "m2", "m3"]


def score(key: str, tag: str, y: str = "y"):
    return F.lit(0.7) * uniform(key, seed=tag) + F.lit(0.3) * F.col(y)


def sql_score(key: str, tag: str, y: str = "y") -> str:
    return f"({dlit(0.7)} * {sql_uniform(key, tag)} + {dlit(0.3)} * {y})"


def scores_view(spark: SparkSession, sf: str) -> DataFrame:
    o = orders_view(spark, sf)
    out = o.select("id", "grp", "cat", "num", "y", "is_train", "label")
    for m in MODELS:
        out = out.withColumn(f"p_{m}", score("id", m))
    out = out.withColumn("p_mlp", score("id", "mlp"))
    return out.withColumn("p_avg", (F.col("p_m1") + F.col("p_m2") + F.col("p_m3")) / F.lit(3.0))


S_CTE = O_CTE + ",\n" + "s AS (SELECT id, grp, cat, num, y, is_train, label, " + ", ".join(
    f"{sql_score('id', m)} AS p_{m}" for m in MODELS) + f", {sql_score('id', 'mlp')} AS p_mlp FROM o),\n" + \
    "sa AS (SELECT *, (p_m1 + p_m2 + p_m3) / CAST(3 AS DOUBLE) AS p_avg FROM s)"


# -- E5: events pivoted to five amounts per user, with the user's segment ----

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
AMOUNTS = [f"a_{t}" for t in EVENT_TYPES]


def amounts_view(spark: SparkSession, sf: str) -> DataFrame:
    ev = read_table(spark, sf, "events")
    cu = read_table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"),
                                                   F.col("c_mktsegment").alias("seg"))
    piv = (ev.groupBy("user_id").pivot("event_type", EVENT_TYPES)
             .agg(F.round(F.sum("value"), 2)))
    for t in EVENT_TYPES:
        piv = piv.withColumnRenamed(t, f"a_{t}")
    piv = piv.fillna(0.0, AMOUNTS)
    return piv.join(cu, "user_id", "left")


E5_CTE = "e5 AS (SELECT p.user_id, c.c_mktsegment AS seg, " + ", ".join(
    f"coalesce(round(sum(CASE WHEN event_type = '{t}' THEN value END), 2), 0.0) AS a_{t}"
    for t in EVENT_TYPES) + \
    " FROM events p LEFT JOIN customer c ON p.user_id = c.c_custkey GROUP BY p.user_id, c.c_mktsegment)"
