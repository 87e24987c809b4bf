"""Group features from labels and group-level post-processing.

All group statistics are an aggregate joined back to the rows (never a
``Window.partitionBy(key)`` over data rows): a hot key (a sentinel value, an
``Unknown`` surname) is pre-combined map-side, and the join-back is a many-to-
one lookup that AQE can broadcast or skew-split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .stats import attach_global, global_label_mean, group_size_table, label_stats_table, lookup


def loo_target_mean(train: DataFrame, key: str, label: str, prefix: str = "loo",
                    prior: float | None = None, singleton: str = "zero") -> DataFrame:
    """Leave-one-out label mean per row: (sum_key - y) / max(count_key - 1, 1),
    and agreement max(m, 1 - m). A row without a key takes the prior (the
    global label mean when ``prior`` is None).

    ``singleton='zero'`` keeps the source behaviour (a key seen once gives
    0 / 1 = 0); ``'prior'`` gives such rows the prior instead."""
    stats = train.groupBy(key).agg(F.sum(label).alias("_s"), F.count(label).alias("_n"))
    out = lookup(train, stats, key)
    loo_sum = F.greatest(F.col("_s") - F.col(label), F.lit(0))
    loo_n = F.greatest(F.col("_n") - 1, F.lit(1))
    # greatest skips NULLs: a row whose key found no statistic keeps NULL here
    mean = F.when(F.col("_n").isNotNull() & F.col(label).isNotNull(), loo_sum / loo_n)
    if singleton == "prior":
        mean = F.when(F.col("_n") <= 1, F.lit(None)).otherwise(mean)
    if prior is None:
        out = attach_global(out, global_label_mean(train, label, "_prior"))
        prior_c = F.col("_prior")
    else:
        prior_c = F.lit(float(prior))
    out = out.withColumn(f"{prefix}_mean", F.coalesce(mean.cast("double"), prior_c))
    m = F.col(f"{prefix}_mean")
    out = out.withColumn(f"{prefix}_agreement", F.greatest(m, 1 - m))
    return out.drop("_s", "_n", *(["_prior"] if prior is None else []))


def test_group_mean(train: DataFrame, test: DataFrame, key: str, label: str,
                    prefix: str = "loo", prior: float | None = None,
                    agreement_default: float = 0.5) -> DataFrame:
    """Rows without labels: plain label mean of the key in ``train`` (default:
    the prior) and agreement (default 0.5)."""
    stats = label_stats_table(train, key, label, "_g").select(key, "_g_mean", "_g_agreement")
    out = lookup(test, stats, key)
    if prior is None:
        out = attach_global(out, global_label_mean(train, label, "_prior"))
        prior_c = F.col("_prior")
    else:
        prior_c = F.lit(float(prior))
    out = (out.withColumn(f"{prefix}_mean", F.coalesce(F.col("_g_mean"), prior_c))
              .withColumn(f"{prefix}_agreement",
                          F.coalesce(F.col("_g_agreement"), F.lit(float(agreement_default)))))
    return out.drop("_g_mean", "_g_agreement", *(["_prior"] if prior is None else []))


def group_known_rate(train: DataFrame, test: DataFrame, key: str, label: str,
                     id_col: str) -> DataFrame:
    """Test rows: known flag (key seen in train) and known rate = train count /
    count over train and test together, clipped to [0, 1]."""
    train_n = train.groupBy(key).agg(F.count(label).alias("_tn"))
    both = train.select(key, id_col).unionByName(test.select(key, id_col))
    total = both.groupBy(key).agg(F.count(id_col).alias("_tot"))
    out = lookup(lookup(test, train_n, key), total, key)
    rate = F.coalesce(F.col("_tn"), F.lit(0)) / F.coalesce(F.col("_tot"), F.lit(1))
    out = (out.withColumn("known", F.col("_tn").isNotNull().cast("int"))
              .withColumn("known_rate", F.least(F.greatest(rate, F.lit(0.0)), F.lit(1.0))))
    return out.drop("_tn", "_tot")


def group_label_propagation(train: DataFrame, test: DataFrame, key: str, label: str,
                            id_col: str, default: float = 0.5) -> DataFrame:
    """Group mean / agreement / known / known-rate for train and test rows.

    Train: leave-one-out mean (missing key -> ``default``), known = key matched,
    rate 1.0. Test: plain group mean and agreement (default 0.5), known flag and
    rate as in :func:`group_known_rate`."""
    stats = train.groupBy(key).agg(F.sum(label).alias("_s"), F.count(label).alias("_n"))
    tr = lookup(train, stats, key)
    loo = F.when(F.col("_n").isNotNull() & F.col(label).isNotNull(),
                 F.greatest(F.col("_s") - F.col(label), F.lit(0)) / F.greatest(F.col("_n") - 1, F.lit(1)))
    tr = (tr.withColumn("group_mean", F.coalesce(loo.cast("double"), F.lit(default)))
            .withColumn("group_agreement", F.greatest(F.col("group_mean"), 1 - F.col("group_mean")))
            .withColumn("known", F.col("_n").isNotNull().cast("int"))
            .withColumn("known_rate", F.lit(1.0))
            .drop("_s", "_n"))
    te = test_group_mean(train, test, key, label, "group", prior=default,
                         agreement_default=default)
    te = group_known_rate(train, te, key, label, id_col)
    return tr.unionByName(te, allowMissingColumns=True)


def group_consistency(df: DataFrame, key: str, prob: str, locked: str | None = None,
                      confidence: float = 0.75, min_size: int = 3,
                      out: str = "prob_adj") -> DataFrame:
    """Pull members of confident groups further the same way.

    Groups with at least ``min_size`` rows: mean > confidence ->
    clip(0.7 p + 0.3, 0.5, 1); mean < 1 - confidence -> clip(0.7 p, 0, 0.5);
    rows with a lock keep their original p. Adds ``adjusted`` (1 if the row's
    group was adjusted, locked rows included)."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("_gn"), F.avg(prob).alias("_gm"))
    o = lookup(df, g, key)
    p, n, m = F.col(prob), F.col("_gn"), F.col("_gm")
    big = F.coalesce(n >= min_size, F.lit(False))
    hi = big & (m > confidence)
    lo = big & (m < 1 - confidence)
    adj = (F.when(p.isNull(), p).when(hi, F.least(F.greatest(p * 0.7 + 0.3, F.lit(0.5)), F.lit(1.0)))
            .when(lo, F.least(F.greatest(p * 0.7, F.lit(0.0)), F.lit(0.5)))
            .otherwise(p))
    if locked is not None:
        adj = F.when(F.col(locked).isNotNull(), p).otherwise(adj)
    return (o.withColumn(out, adj)
             .withColumn("adjusted", (hi | lo).cast("int"))
             .drop("_gn", "_gm"))


def group_size_features(df: DataFrame, key: str, size_col: str = "group_size") -> DataFrame:
    return lookup(df, group_size_table(df, key, size_col), key)


def member_features(df: DataFrame, key: str, order: str, id_col: str, value: str, n_chunks: int = 64) -> DataFrame:
    """Per row: ``member_rank`` in its group by (``order``, ``id_col``), NULL first,
    ``group_size``, ``is_first``, ``is_last``, and mean, population standard deviation
    and range of ``value`` in the group.

    The rank is a two-level prefix sum: ``order`` is cut at approximate quantiles of the
    whole table, a row's rank is the group's rows in earlier chunks plus its place in
    its own, so a group of a third of the rows is ranked by many tasks (rows of one
    ``order`` value stay together). NULL is a group; results do not depend on
    ``n_chunks``."""
    times = df.select(order).dtypes[0][1] in ("date", "timestamp", "timestamp_ntz")
    numeric = (F.col(order).cast("timestamp") if times else F.col(order)).cast("double")
    grid = [k / n_chunks for k in range(1, n_chunks)]
    cuts = df.agg(F.array_distinct(F.percentile_approx(numeric, grid, 100 * n_chunks)).alias("_cuts"))
    rows = attach_global(df.withColumn("_o", numeric), cuts).withColumn(
        "_chunk", F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col("_o"))), F.lit(0)) + F.col("_o").isNotNull().cast("int"))
    rows = rows.drop("_cuts")
    counts = rows.groupBy(F.col(key).alias("_k"), F.col("_chunk").alias("_c")).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_k").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_k", "_c", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy(key, "_chunk").orderBy(F.col("_o").asc_nulls_first(), id_col))
    ranked = rows.withColumn("_place", place).join(
        starts, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_chunk") == F.col("_c")))
    ranked = ranked.withColumn("member_rank", (F.col("_start") + F.col("_place")).cast("long")).drop(
        "_k", "_c", "_chunk", "_o", "_start", "_place")
    stats = df.groupBy(F.col(key).alias("_g")).agg(
        F.count("*").alias("group_size"), F.avg(value).alias("group_mean"), F.stddev_pop(value).alias("group_std"),
        (F.max(value) - F.min(value)).alias("group_range"))
    out = ranked.join(stats, F.col(key).eqNullSafe(F.col("_g"))).drop("_g")
    return (out.withColumn("is_first", (F.col("member_rank") == 1).cast("int"))
            .withColumn("is_last", (F.col("member_rank") == F.col("group_size")).cast("int")))
