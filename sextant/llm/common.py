"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, ship  # noqa: F401
from ..sources.tables import read_table

#: Largest side that is sent to every task by an explicit broadcast, in rows of a
#: few numbers each; a larger side is shuffled instead.
BROADCAST_ROWS = 1_000_000

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}

WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None):
    """Register a query (spark, sf_dir) -> DataFrame with its oracle SQL."""
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: later
    steps start from files that outlive a lost executor, with known sizes."""
    return cut_lineage(df)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, else as it
    is (a shuffle join). ``df`` should be a staged table, so counting is cheap."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def release_memory() -> None:
    """Hand the freed memory of this worker process back to the system: a worker
    lives on between tasks, next to stages that run in the JVM alone."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):        # another C library: nothing to trim
        pass


def trimmed(run):
    """``run`` (batches to batches) that hands freed memory back when a task ends."""
    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release_memory()
    return wrapped


def crc_mod(id_col: str, mod: int):
    """crc32 of the id as text, modulo ``mod``; NULL for a NULL id."""
    return F.crc32(F.col(id_col).cast("string")) % F.lit(mod)


def word_count(text_col: str):
    """Number of words in a text, 0 for NULL."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (src, dst longs) by alternating
    large-star and small-star rounds: (node, root), root the smallest node of
    the component, for every node that has an edge. Every round is a partial
    aggregate and a join keyed by node, written to the shared folder; no link
    list reaches the driver. NULL ends and self links are ignored."""
    e = staged(edges.where("src is not null and dst is not null and src <> dst")
               .select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())
    sign = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u and v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small_star = (large.join(low2, "u").where("v <> m")
                      .select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .unionByName(low2.select("u", F.col("m").alias("v")))
                      .where("u <> v").distinct())
        e = staged(small_star)
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"),
                    ).first()
        if sign == (now.n, now.s):
            break
        sign = (now.n, now.s)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
