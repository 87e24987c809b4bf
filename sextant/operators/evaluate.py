"""Scoring of probability columns: accuracy at a cut, one-pass threshold
sweep over many cuts and candidates, confusion matrix, ROC AUC, reliability.

The source scores 121 cuts by 121 passes over the data, and a weight search
repeats that for 25 weights (3,025 passes). Here every row is reduced once to
(candidate, bucket) counts, where bucket = number of cuts <= p; the accuracy at
every cut is then a cumulative sum over at most 122 buckets per candidate.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stats import same_keys

# The cut grid is 121 evenly spaced cuts from 0.35 to 0.65.
CUT_LO_BP, CUT_STEP_BP, N_CUTS = 3500, 25, 121   # in 1/10000 units


def cut_value(i) -> Column:
    """Cut i as the nearest double to (3500 + 25 i) / 10000."""
    i = F.lit(i) if isinstance(i, int) else i
    return (F.lit(CUT_LO_BP) + F.lit(CUT_STEP_BP) * i).cast("double") / F.lit(10000.0)


def cuts_below(p) -> Column:
    """Exact number of cuts t_i with t_i <= p (0 .. 121): an arithmetic guess
    corrected by comparing with the exact cut values on both sides."""
    p = F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit(float("-inf")))
    p = F.greatest(p, F.lit(-1.0))          # missing scores lie below every cut
    guess = F.floor((p * 10000.0 - CUT_LO_BP) / CUT_STEP_BP).cast("int") + 1
    b = F.least(F.greatest(guess, F.lit(0)), F.lit(N_CUTS))
    b = F.when((b < N_CUTS) & (cut_value(b) <= p), b + 1).otherwise(b)
    b = F.when((b > 0) & (cut_value(b - 1) > p), b - 1).otherwise(b)
    return b


def accuracy_at(prob, label, threshold: float = 0.5) -> Column:
    """Share of rows whose prediction ``p >= threshold`` is the label; a missing score
    is not above any cut."""
    p = F.col(prob) if isinstance(prob, str) else prob
    above = F.coalesce(p >= threshold, F.lit(False))
    return F.avg((above.cast("int") == F.col(label)).cast("int").cast("double"))


def threshold_sweep(df: DataFrame, prob: str, label: str,
                    group: Sequence[str] = ()) -> DataFrame:
    """Accuracy of ``p >= t_i`` for all 121 cuts, per group of ``group`` columns.

    Rows -> (group, bucket, pos, neg) in one partial aggregate; a dense grid of
    122 buckets per group (cross join with a broadcast 122-row range); then
    cumulative sums over <= 122 rows per group. correct(i) = positives with
    bucket > i + negatives with bucket <= i."""
    group = list(group)
    spark = df.sparkSession
    counts = (df.groupBy(*group, cuts_below(prob).alias("bucket"))
                .agg(F.sum(F.col(label)).alias("_pos"),
                     F.sum(1 - F.col(label)).alias("_neg")))
    buckets = spark.range(N_CUTS + 1).select(F.col("id").cast("int").alias("bucket"))
    groups = counts.select(*group).distinct() if group else None
    grid = groups.crossJoin(F.broadcast(buckets)) if group else buckets
    dense = grid.join(counts, group + ["bucket"], "left").fillna(0, ["_pos", "_neg"])
    w = Window.partitionBy(*group).orderBy("bucket") if group else Window.orderBy("bucket")
    wall = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    cum = dense.select(*group, "bucket",
                       F.sum("_pos").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_cpos"),
                       F.sum("_neg").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_cneg"),
                       F.sum("_pos").over(wall).alias("_tpos"),
                       (F.sum("_pos").over(wall) + F.sum("_neg").over(wall)).alias("_n"))
    res = cum.where(F.col("bucket") < N_CUTS).select(
        *group, F.col("bucket").alias("cut_index"),
        cut_value(F.col("bucket")).alias("threshold"),
        (F.col("_tpos") - F.col("_cpos") + F.col("_cneg")).cast("bigint").alias("correct"),
        F.col("_n").cast("bigint").alias("n"))
    return res.withColumn("accuracy", F.try_divide(F.col("correct"), F.col("n")))


def best_threshold(sweep: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Per group: the cut with the highest accuracy, lowest cut on ties."""
    group = list(group)
    key = F.struct((-F.col("correct")).alias("c"), F.col("cut_index").alias("i"))
    aggs = [F.min_by("cut_index", key).alias("cut_index"),
            F.min_by("threshold", key).alias("threshold"),
            F.max("correct").alias("correct"),
            F.first("n").alias("n")]
    out = sweep.groupBy(*group).agg(*aggs) if group else sweep.agg(*aggs)
    return out.withColumn("accuracy", F.try_divide(F.col("correct"), F.col("n")))


def stack_candidates(df: DataFrame, id_col: str, label: str, cands: dict[str, Column]) -> DataFrame:
    """Long table (id, label, candidate, prob) from named probability columns."""
    arr = F.array(*[F.struct(F.lit(k).alias("candidate"), v.cast("double").alias("prob"))
                    for k, v in cands.items()])
    return df.select(id_col, label, F.explode(arr).alias("_c")).select(
        id_col, label, "_c.candidate", "_c.prob")


def weight_grid(lo: float = 0.2, hi: float = 0.8, n: int = 25) -> list[float]:
    return [lo + (hi - lo) * j / (n - 1) for j in range(n)]


def blend_weight_search(df: DataFrame, label: str, a: str, b: str,
                        weights: Sequence[float] | None = None) -> DataFrame:
    """For p_w = w a + (1 - w) b over the weight grid: best cut and accuracy per
    weight, in one exploded aggregate (not one pass per weight and cut)."""
    weights = list(weights or weight_grid())
    wi = F.explode(F.array(*[F.lit(i) for i in range(len(weights))])).alias("weight_index")
    warr = F.array(*[F.lit(float(w)) for w in weights])
    ex = df.select(label, a, b, wi)
    ex = ex.withColumn("weight", F.element_at(warr, F.col("weight_index") + 1))
    ex = ex.withColumn("_p", F.col("weight") * F.col(a) + (1 - F.col("weight")) * F.col(b))
    sweep = threshold_sweep(ex, "_p", label, ["weight_index", "weight"])
    return best_threshold(sweep, ["weight_index", "weight"])


def first_strict_best(results: DataFrame, order_col: str) -> DataFrame:
    """The row with the highest ``correct``; on ties the first in ``order_col``
    order (a later candidate must be strictly better to win)."""
    key = F.struct((-F.col("correct")).alias("c"), F.col(order_col).alias("o"))
    cols = [c for c in results.columns]
    return results.agg(*[F.min_by(c, key).alias(c) for c in cols])


def choose_candidate(df: DataFrame, id_col: str, label: str, cands: dict, order: Sequence[str]) -> DataFrame:
    """Best cut per candidate probability column and the chosen candidate:
    highest accuracy, ties to the candidate listed first in ``order`` (so a
    later candidate must be strictly better). One exploded, bucketed pass."""
    lg = stack_candidates(df, id_col, label, cands)
    spark = df.sparkSession
    rank = spark.createDataFrame([(c, i) for i, c in enumerate(order)], "candidate string, ord int")
    best = best_threshold(threshold_sweep(lg, "prob", label, ["candidate"]), ["candidate"])
    best = best.join(F.broadcast(rank), "candidate")          # one row per candidate
    win = first_strict_best(best, "ord").select(F.col("candidate").alias("_w"))
    best = best.join(F.broadcast(win), F.col("candidate") == F.col("_w"), "left")
    return best.withColumn("chosen", F.col("_w").isNotNull().cast("int")).drop("_w", "ord")


def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("pred")).agg(
        F.count(F.lit(1)).alias("n"))


def roc_auc(df: DataFrame, prob: str, label: str, group: Sequence[str] = (),
            n_chunks: int = 128) -> DataFrame:
    """Exact ROC AUC (ties count one half) per group, with n_pos, n_neg and
    n_missing: rows without a score or label, which take no part.

    AUC = sum over scores s of pos(s) * (neg(< s) + neg(s) / 2) / (P N).
    Rows -> counts per distinct score (partial aggregate); the running count of
    negatives below each score is a two-level prefix sum: totals and offsets of
    ``n_chunks`` chunks at approximate quantiles of the distinct scores (so scores in
    a narrow range spread like any others), then a window inside each chunk. No step
    orders all scores in one task."""
    group = list(group)
    usable = F.col(prob).isNotNull() & F.col(label).isNotNull()
    tally = F.sum(F.when(usable, 0).otherwise(1)).cast("bigint").alias("n_missing")
    missing = df.groupBy(*group).agg(tally) if group else df.agg(tally)
    per = df.where(usable).groupBy(*group, F.col(prob).alias("_s")).agg(
        F.sum(F.col(label)).alias("_pos"), F.sum(1 - F.col(label)).alias("_neg"))
    grid = [k / n_chunks for k in range(1, n_chunks)]
    cuts = F.array_distinct(F.percentile_approx("_s", grid, 10 * n_chunks)).alias("_b")
    bounds = per.groupBy(*group).agg(cuts) if group else per.agg(cuts)
    per = same_keys(per, bounds, group).withColumn(
        "_chunk", F.size(F.filter("_b", lambda b: b < F.col("_s")))).drop("_b")
    ch = per.groupBy(*group, "_chunk").agg(F.sum("_neg").alias("_cn"))
    wch = Window.partitionBy(*group).orderBy("_chunk") if group else Window.partitionBy(F.lit(0)).orderBy("_chunk")
    ch = ch.select(*group, "_chunk", (F.sum("_cn").over(wch) - F.col("_cn")).alias("_off"))
    win = Window.partitionBy(*group, "_chunk").orderBy("_s")
    per = same_keys(per, ch, group + ["_chunk"])
    per = per.withColumn("_below", F.col("_off") + F.sum("_neg").over(win) - F.col("_neg"))
    contrib = F.col("_pos") * (F.col("_below") + F.col("_neg") / 2.0)
    # one class only: AUC is undefined -> NULL (try_divide: no error under ANSI mode)
    aggs = [F.try_divide(F.sum(contrib), F.sum("_pos") * F.sum("_neg")).alias("auc"),
            F.coalesce(F.sum("_pos"), F.lit(0)).cast("bigint").alias("n_pos"),
            F.coalesce(F.sum("_neg"), F.lit(0)).cast("bigint").alias("n_neg")]
    if not group:
        return per.agg(*aggs).crossJoin(F.broadcast(missing))       # one row each
    got = per.groupBy(*group).agg(*aggs)
    tagged = got.select(*[F.col(g).alias(f"_g_{g}") for g in group], "auc", "n_pos", "n_neg")
    on = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group])
    return missing.join(tagged, on, "left").select(
        *group, "auc", F.coalesce("n_pos", F.lit(0)).cast("bigint").alias("n_pos"),
        F.coalesce("n_neg", F.lit(0)).cast("bigint").alias("n_neg"), "n_missing")


def reliability_curve(df: DataFrame, prob: str, label: str, n_bins: int = 15) -> DataFrame:
    """Equal-width bins on [0, 1], right-closed (0 in the first bin); empty bins
    are absent. Mean predicted probability and fraction of positives."""
    b = F.least(F.greatest(F.ceil(F.col(prob) * n_bins).cast("int") - 1, F.lit(0)), F.lit(n_bins - 1))
    return df.groupBy(b.alias("bin")).agg(
        F.avg(prob).alias("mean_predicted"), F.avg(F.col(label).cast("double")).alias("fraction_positive"),
        F.count(F.lit(1)).alias("n"))


def probability_histograms(df: DataFrame, scores: dict, by=(), bins: int = 30) -> DataFrame:
    """Counts of each score column in even bins of [0, 1], per group: (model, *by, bin, n).

    The last bin is closed; scores outside [0, 1] go to the nearest bin, NULL and NaN
    scores are not counted. One scan and one partial aggregate for all scores."""
    by = list(by)
    long = df.select(*by, F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("p"))
                                              for m, c in scores.items()])).alias("_s"))
    place = F.least(F.greatest(F.floor(F.col("_s.p") * bins), F.lit(0)), F.lit(bins - 1)).cast("int")
    return (long.where(F.col("_s.p").isNotNull() & ~F.isnan("_s.p")).groupBy(F.col("_s.model").alias("model"), *by, place.alias("bin"))
                .agg(F.count(F.lit(1)).alias("n")))
