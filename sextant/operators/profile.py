"""Exploratory aggregates (the numbers behind the source's charts).

Each is one or two aggregates; global quantiles are a one-row aggregate
broadcast back. Long (unpivoted) outputs keep the schema fixed whatever the
number of input columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .stats import attach_global, percentile_table


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """(value): the distinct values of a column in ascending order, NULL left out."""
    return df.select(F.col(col).alias("value")).where("value IS NOT NULL").distinct().orderBy("value")


def value_counts(df: DataFrame, col: str, missing: str | None = None) -> DataFrame:
    v = F.col(col) if missing is None else F.coalesce(F.col(col).cast("string"), F.lit(missing))
    counts = df.groupBy(v.alias(col)).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("_tot"))
    return (attach_global(counts, total)
            .withColumn("share", F.col("n") / F.col("_tot")).drop("_tot")
            .orderBy(F.desc("n"), F.asc(col)))


def null_rates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Share of NULL per column; only columns with NULLs, highest first."""
    one = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    long = one.unpivot([], list(cols), "column", "null_rate")
    return long.where(F.col("null_rate") > 0).orderBy(F.desc("null_rate"), F.asc("column"))


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, sample std, min, exact quartiles, max per column (long).
    Moments in one aggregate; all quartiles of all columns in one percentile
    table (one-row results, joined by a broadcast cross join)."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(c).alias(f"_n{i}"), F.avg(c).alias(f"_m{i}"), F.stddev_samp(c).alias(f"_s{i}"),
                 F.min(F.col(c).cast("double")).alias(f"_lo{i}"), F.max(F.col(c).cast("double")).alias(f"_hi{i}")]
    qs = [0.25, 0.5, 0.75]
    names = {(c, q): f"_q{i}_{j}" for i, c in enumerate(cols) for j, q in enumerate(qs)}
    one = attach_global(df.agg(*aggs), percentile_table(df, [], list(cols), qs, names))
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("count"), F.col(f"_m{i}").alias("mean"),
                     F.col(f"_s{i}").alias("std"), F.col(f"_lo{i}").alias("min"),
                     F.col(f"_q{i}_0").alias("q25"), F.col(f"_q{i}_1").alias("q50"),
                     F.col(f"_q{i}_2").alias("q75"), F.col(f"_hi{i}").alias("max"))
            for i, c in enumerate(cols)]
    return one.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair (lower triangle incl. diagonal),
    pairwise complete, in one aggregate."""
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[: i + 1]]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_c{i}")
                   for i, (a, b) in enumerate(pairs)])
    arr = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"_c{i}").alias("corr"))
                    for i, (a, b) in enumerate(pairs)])
    return one.select(F.explode(arr).alias("p")).select("p.*")


def class_histogram(df: DataFrame, col: str, cls: str, n_bins: int = 40) -> DataFrame:
    """Equal-width histogram per class over the class's own [min, max]; the
    last bin is closed. Empty bins are absent."""
    rng = df.groupBy(cls).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    x = df.where(F.col(col).isNotNull()).join(rng, cls)
    w = (F.col("_hi") - F.col("_lo")) / n_bins
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col(col) - F.col("_lo")) / w).cast("int"), F.lit(n_bins - 1)))
    return x.groupBy(cls, b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.first("_lo").alias("lo"), F.first("_hi").alias("hi"))


def crosstab_pct(df: DataFrame, row: str, col: str, missing: str = "Missing") -> DataFrame:
    """Counts per (row, col) with NULL shown as ``missing``, and the row share."""
    r = F.coalesce(F.col(row).cast("string"), F.lit(missing)).alias(row)
    c = F.coalesce(F.col(col).cast("string"), F.lit(missing)).alias(col)
    counts = df.groupBy(r, c).agg(F.count(F.lit(1)).alias("n"))
    tot = counts.groupBy(row).agg(F.sum("n").alias("_rt"))
    return counts.join(tot, row).withColumn("row_pct", F.col("n") * 100.0 / F.col("_rt")).drop("_rt")


def pivot_mean(df: DataFrame, row: str, col: str, values: Sequence | None, target: str,
               missing: str | None = None) -> DataFrame:
    """Mean of ``target`` per (row, col), pivoted with an explicit value list
    (no extra job to discover the values), or with ``values=None`` over every value
    there is (one more job; Spark stops above ``spark.sql.pivotMaxValues``).
    ``missing`` names the column of NULL values."""
    if missing is not None:
        df = df.withColumn(col, F.coalesce(F.col(col).cast("string"), F.lit(missing)))
    grouped = df.groupBy(row)
    return (grouped.pivot(col) if values is None else grouped.pivot(col, list(values))).agg(F.avg(target))


def rate_by_category(df: DataFrame, cat: str, target: str) -> DataFrame:
    return (df.groupBy(cat).agg(F.avg(F.col(target).cast("double")).alias("rate"),
                                F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("rate"), F.asc(cat)))


def top_n(df: DataFrame, order, n: int) -> DataFrame:
    """Top-n by an ordering (TakeOrderedAndProject: a per-task top-n, merged)."""
    return df.orderBy(*order).limit(n)


def boxplot_stats(df: DataFrame, col: str, group: Sequence[str] = ()) -> DataFrame:
    """q1, median, q3 and whiskers (extreme values inside 1.5 IQR)."""
    group = list(group)
    qs = percentile_table(df, group, col, [0.25, 0.5, 0.75],
                          {(col, 0.25): "q1", (col, 0.5): "median", (col, 0.75): "q3"})
    # per-group quantile table: its size is the number of groups, so the join
    # strategy is left to AQE; the global case is one row and is broadcast
    x = df.join(qs, group) if group else attach_global(df, qs)
    iqr = F.col("q3") - F.col("q1")
    inside_lo = F.when(F.col(col) >= F.col("q1") - 1.5 * iqr, F.col(col))
    inside_hi = F.when(F.col(col) <= F.col("q3") + 1.5 * iqr, F.col(col))
    aggs = [F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
            F.min(inside_lo).alias("whisker_lo"), F.max(inside_hi).alias("whisker_hi"),
            F.sum(((F.col(col) < F.col("q1") - 1.5 * iqr) | (F.col(col) > F.col("q3") + 1.5 * iqr))
                  .cast("int")).cast("bigint").alias("n_outliers")]
    return x.groupBy(*group).agg(*aggs) if group else x.agg(*aggs)


def winsorize(df: DataFrame, cols: Sequence[str], q: float = 0.99) -> DataFrame:
    """Clip each column at its own q-quantile (one percentile table for all columns)."""
    qs = percentile_table(df, [], list(cols), [q], {(c, q): f"_q_{c}" for c in cols})
    out = attach_global(df, qs)
    for c in cols:
        out = out.withColumn(c, F.least(F.col(c), F.col(f"_q_{c}")))
    return out.drop(*[f"_q_{c}" for c in cols])


def trim_by_class_quantile(df: DataFrame, col: str, cls: str, q: float = 0.98,
                           ) -> DataFrame:
    """Keep rows with x strictly below the q-quantile of their own class."""
    qs = percentile_table(df, cls, col, [q], {(col, q): "_q"})
    return df.join(qs, cls).where(F.col(col) < F.col("_q")).drop("_q")


def running_best(df: DataFrame, key: str, order: Sequence[str], value: str,
                 chunk_col: str | None = None, out: str = "running_best") -> DataFrame:
    """Cumulative maximum of ``value`` per ``key`` in ``order``.

    With ``chunk_col`` (a coarse, order-compatible column such as the day of a
    timestamp) the scan is split so a hot key is not one task: per (key,
    chunk) maxima -> running max over earlier chunks (window on the small
    chunk table) -> running max inside each (key, chunk) partition, combined."""
    order = list(order)
    if chunk_col is None:
        w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.max(value).over(w))
    per = df.groupBy(key, chunk_col).agg(F.max(value).alias("_cm"))
    wc = Window.partitionBy(key).orderBy(chunk_col).rowsBetween(Window.unboundedPreceding, -1)
    prev = per.select(key, chunk_col, F.max("_cm").over(wc).alias("_prev"))
    w = Window.partitionBy(key, chunk_col).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    x = df.join(prev, [key, chunk_col], "left").withColumn("_in", F.max(value).over(w))
    return x.withColumn(out, F.greatest(F.col("_in"), F.col("_prev"))).drop("_in", "_prev")
