"""Repeatable fold assignment and out-of-fold averaging.

A fold is a function of (key, seed): hash mod k. The hash does not depend on
the label, so each class is split into k near-equal parts (the deviation is
O(sqrt(n / k)), negligible at scale); no per-class window or ordering is
needed, and a re-run task reproduces the same folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash32


def fold_of(key, seed: int, k: int) -> Column:
    return F.pmod(hash32(key, seed=seed), F.lit(k)).cast("int")


def stratified_folds(df: DataFrame, key: str, k: int = 5, seed: int = 42,
                     out: str = "fold") -> DataFrame:
    return df.withColumn(out, fold_of(key, seed, k))


def exact_stratified_folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42,
                           n_chunks: int | None = None, rows_per_chunk: int = 1_000_000,
                           out: str = "fold") -> DataFrame:
    """Folds with exact class balance: inside each class, rows are ranked by
    (hash(key, seed), key) and fold = rank mod k, so per class the fold sizes
    differ by at most one (the source's stratified split), and the assignment
    is repeatable.

    The rank is a two-level prefix sum, so no class is ordered in one task:
    the hash is uniform, so equal hash ranges ("chunks") hold equal shares of
    each class; chunk offsets are a running sum over <= n_chunks rows per
    class, and the rank inside a chunk is a window over that chunk only."""
    if n_chunks is None:      # >= 1024 chunks, and about rows_per_chunk rows each
        n_chunks = max(1024, -(-df.count() // rows_per_chunk))
    h = hash32(key, seed=seed)
    x = df.withColumn("_h", h).withColumn(
        "_chunk", F.floor(F.col("_h") * F.lit(float(n_chunks)) / F.lit(float(2 ** 32))).cast("int"))
    sizes = x.groupBy(label, "_chunk").agg(F.count(F.lit(1)).alias("_cn"))
    offs = sizes.select(label, "_chunk", (F.sum("_cn").over(
        Window.partitionBy(label).orderBy("_chunk")) - F.col("_cn")).alias("_off"))
    offs = offs.withColumnRenamed(label, "_cls").withColumnRenamed("_chunk", "_ch")
    # null-safe: rows without a label form their own class
    x = x.join(offs, x[label].eqNullSafe(offs["_cls"]) & (x["_chunk"] == offs["_ch"])).drop("_cls", "_ch")
    rank = F.col("_off") + F.row_number().over(Window.partitionBy(label, "_chunk").orderBy("_h", key)) - 1
    return x.withColumn(out, F.pmod(rank, F.lit(k)).cast("int")).drop("_h", "_chunk", "_off")


def repeated_folds(df: DataFrame, key: str, seeds: Sequence[int], k: int = 5,
                   offset: int = 0) -> DataFrame:
    """(rows x seeds) with columns seed, fold; effective seed = seed + offset."""
    seeds_col = F.explode(F.array(*[F.lit(int(s) + offset) for s in seeds]))
    out = df.withColumn("seed", seeds_col)
    # same draw as fold_of(key, seed, k) for each seed: md5(key || ':' || seed)
    return out.withColumn("fold", F.pmod(hash32(F.col(key), F.col("seed"), seed=None),
                                         F.lit(k)).cast("int"))


def oof_average(preds: DataFrame, keys: Sequence[str] = ("id", "model"),
                prob: str = "prob") -> DataFrame:
    """Average predictions over seeds / runs: sum / max(count, 1)."""
    return preds.groupBy(*keys).agg(
        (F.sum(prob) / F.greatest(F.count(prob), F.lit(1))).alias("prob"),
        F.count(prob).alias("n_preds"))
