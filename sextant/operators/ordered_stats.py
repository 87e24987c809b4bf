"""Ordered target statistics and a booster on raw categories.

A training row's statistic of a category is the smoothed label mean of the rows before
it in a random order with the same value, so it never holds its own label. The order
is by hash of the key, so it is repeatable. Sums of earlier rows are two-level prefix
sums: totals per (column, value, hash range), running totals over the ranges of a
value, and a window inside each range. A value of a third of the rows is spread over
all ranges. Rows to score take the statistic of all training rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash32
from ..session import cut_lineage
from .crossfit import HELD, Booster
from .stats import attach_global, global_label_mean, lookup

MISSING = "__MISSING__"


def _value(c: str):
    return F.coalesce(F.col(c).cast("string"), F.lit(MISSING))


def ordered_target_statistics(df: DataFrame, id_col: str, cols: Sequence[str], label: str, seed: int = 42,
                              weight: float = 1.0, n_chunks: int | None = None, prefix: str = "os_") -> DataFrame:
    """(id, ``os_<c>`` per column): (sum of earlier labels + weight * prior) / (earlier
    labels + weight), prior = mean label of ``df``.

    ``id_col`` is unique. NULL is a value like any other. Rows without a label get a
    statistic and add nothing to later ones; if no row has a label it is NULL. Ties of the
    hash go by key. ``n_chunks`` (by default one per million rows, 64 at least) only cuts
    the work; an empty table gives an empty result."""
    if n_chunks is None:
        n_chunks = max(64, -(-df.count() // 1_000_000))
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), _value(c).alias("v")) for c in cols])
    long = (df.select(F.col(id_col).alias("_id"), F.col(label).cast("double").alias("_y"), hash32(id_col, seed=f"{seed}:order").alias("_h"),
                      F.explode(pairs).alias("_p"))
            .select("_id", "_y", "_h", F.col("_p.c").alias("_c"), F.col("_p.v").alias("_v"),
                    F.floor(F.col("_h") * F.lit(float(n_chunks)) / F.lit(float(1 << 32))).cast("int").alias("_k")))
    totals = long.groupBy("_c", "_v", "_k").agg(F.sum("_y").alias("_s"), F.count("_y").alias("_n"))
    before = Window.partitionBy("_c", "_v").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    start = totals.select("_c", "_v", "_k", F.coalesce(F.sum("_s").over(before), F.lit(0.0)).alias("_s0"),
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"))
    inside = Window.partitionBy("_c", "_v", "_k").orderBy("_h", "_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = (long.withColumn("_s1", F.coalesce(F.sum("_y").over(inside), F.lit(0.0)))
            .withColumn("_n1", F.coalesce(F.count("_y").over(inside), F.lit(0))).join(start, ["_c", "_v", "_k"]))
    rows = attach_global(rows, global_label_mean(df, label, "_prior"))
    stat = (F.col("_s0") + F.col("_s1") + F.lit(weight) * F.col("_prior")) / (F.col("_n0") + F.col("_n1") + F.lit(weight))
    wide = rows.select("_id", "_c", stat.alias("_t")).groupBy("_id").agg(
        *[F.max(F.when(F.col("_c") == c, F.col("_t"))).alias(f"{prefix}{c}") for c in cols])
    return wide.withColumnRenamed("_id", id_col)


def target_statistics(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """(col, value, s, n) over all rows of ``df`` with a label."""
    pairs = F.array(*[F.struct(F.lit(c).alias("col"), _value(c).alias("value")) for c in cols])
    return (df.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("_y"), F.explode(pairs).alias("p"))
            .groupBy("p.col", "p.value").agg(F.sum("_y").alias("s"), F.count("_y").alias("n")))


def apply_statistics(df: DataFrame, table: DataFrame, cols: Sequence[str], prior: float | None, weight: float = 1.0,
                     prefix: str = "os_") -> DataFrame:
    """``df`` with ``os_<c>`` from the statistics of all training rows; a value they do
    not hold takes the prior."""
    out = df
    for c in cols:
        key = f"_k_{c}"
        mine = table.where(F.col("col") == c).select(F.col("value").alias(key), F.col("s").alias("_s"), F.col("n").alias("_n"))
        out = lookup(out.withColumn(key, _value(c)), mine, key)
        s, n = F.coalesce("_s", F.lit(0.0)), F.coalesce("_n", F.lit(0))
        out = out.withColumn(f"{prefix}{c}", (s + F.lit(weight) * F.lit(prior).cast("double")) / (n + F.lit(weight))).drop("_s", "_n", key)
    return out


class CategoryBooster(Estimator):
    """Boosted trees on raw categories: ordered statistics for the training rows, those
    of all training rows for the held-out rows that choose the rounds and for scoring."""

    def __init__(self, id_col: str, categories: Sequence[str], numbers: Sequence[str], seed: int, label: str = "label",
                 weight: float = 1.0, **params):
        super().__init__()
        self.id_col, self.categories, self.numbers, self.label = id_col, list(categories), list(numbers), label
        self.seed, self.weight = seed, weight
        self.booster = Booster([*self.numbers, *(f"os_{c}" for c in self.categories)], seed, label, **params)

    def _fit(self, df: DataFrame) -> Model:
        own = df.where(~F.col(HELD))
        table = cut_lineage(target_statistics(own, self.categories, self.label))
        prior = own.agg(F.avg(F.col(self.label).cast("double"))).first()[0]
        stats = ordered_target_statistics(own, self.id_col, self.categories, self.label, self.seed, self.weight)
        held = apply_statistics(df.where(HELD), table, self.categories, prior, self.weight)
        rows = own.join(stats, self.id_col)
        # a shuffle, not coalesce: the windows and joins above keep their own tasks
        rows = (rows.unionByName(held.select(*rows.columns)).repartition(max(1, df.rdd.getNumPartitions()), self.id_col)
                .sortWithinPartitions(self.id_col).persist())
        model = self.booster.fit(rows)
        rows.unpersist()
        return CategoryModel(model, table, prior, self)


class CategoryModel(Model):
    """Scores rows by the statistics of all training rows."""

    def __init__(self, model, table: DataFrame, prior, est: CategoryBooster):
        super().__init__()
        self.model, self.table, self.prior, self.categories, self.weight = model, table, prior, est.categories, est.weight

    def _transform(self, df: DataFrame) -> DataFrame:
        out = apply_statistics(df, self.table, self.categories, self.prior, self.weight)
        return self.model.transform(out).select(*df.columns, "prob")
