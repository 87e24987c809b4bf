"""Ordered missing-value fills. The order of steps is part of the result:
each step sees the output of the previous one, as in the source pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import zero_under_flag
from ..session import cut_lineage
from .stats import attach_global, fill_from_table, mode_table, percentile_table


def impute_group_mode(df: DataFrame, key: str, col: str) -> DataFrame:
    """``col`` missing -> most frequent value of ``col`` in the row's ``key`` group."""
    return fill_from_table(df, col, mode_table(df, key, col, "_fill"), key, "_fill")


def impute_category_cascade(df: DataFrame, steps: Sequence[tuple[str, str]],
                            finals: dict[str, object] | None = None) -> DataFrame:
    """Fill categories from related categories, in order.

    ``steps``: (source, target) pairs; target missing -> mode of target among rows
    with the same source value (computed on the current, partly filled frame).
    ``finals``: column -> ``"mode"`` (global mode) or a constant, applied last.

    Every step reads and writes only the columns named in ``steps`` and ``finals``,
    and rows that agree in them are filled alike. So the cascade runs on their
    distinct combinations with counts (one partial aggregate), and one null-safe
    join gives each row the filled combination: the table itself is read twice.
    Only the combinations are written, between steps, to keep the plan small."""
    finals = finals or {}
    cols = list(dict.fromkeys([c for pair in steps for c in pair] + list(finals)))
    combos = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_w"))
    t = combos.select("_w", *[F.col(c).alias(f"_o_{c}") for c in cols], *cols)
    for i, (src, tgt) in enumerate(steps):
        if i and i % 2 == 0:
            t = cut_lineage(t)      # the plan of a step holds the previous one twice
        t = fill_from_table(t, tgt, _weighted_mode(t, [src], tgt), src, "_fill")
    by_mode = [c for c, how in finals.items() if how == "mode"]
    if by_mode and len(steps) > 1:
        t = cut_lineage(t)
    # each final mode is that of its own column after the steps
    modes = [_weighted_mode(t, [], c).withColumnRenamed("_fill", f"_m_{c}") for c in by_mode]
    for c, m in zip(by_mode, modes):
        t = attach_global(t, m).withColumn(c, F.coalesce(F.col(c), F.col(f"_m_{c}"))).drop(f"_m_{c}")
    for c, how in finals.items():
        if how != "mode":
            t = t.withColumn(c, F.coalesce(F.col(c), F.lit(how)))
    t = t.select(*[F.col(f"_o_{c}") for c in cols], *[F.col(c).alias(f"_f_{c}") for c in cols])
    out = df.join(t, [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in cols], "left")
    return out.select(*[F.col(f"_f_{c}").alias(c) if c in cols else F.col(c) for c in df.columns])


def _weighted_mode(t: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Mode of ``col`` per key over rows with weight ``_w`` (ties -> smallest)."""
    counts = t.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.sum("_w").alias("_n"))
    best = F.min_by(F.col(col), F.struct((-F.col("_n")).alias("n"), F.col(col).alias("v"))).alias("_fill")
    return counts.groupBy(*keys).agg(best) if keys else counts.agg(best)


def impute_median_cascade(df: DataFrame, col: str, group_keys: Sequence[str]) -> DataFrame:
    """``col`` missing -> median in the first key's group -> in the next key's
    group ... -> global median. All medians come from the unfilled column. A row
    whose key is NULL has no group.

    Only groups that hold a missing value need a median, so each key's percentile
    pass reads the rows of those groups; the global median has a pass of its own."""
    meds = []
    for i, k in enumerate(group_keys):
        need = df.where(F.col(col).isNull() & F.col(k).isNotNull()).select(F.col(k).alias(f"_k{i}")).distinct()
        rows = df.select(k, col).where(F.col(col).isNotNull()).join(need, F.col(k) == F.col(f"_k{i}"), "left_semi")
        t = percentile_table(rows, k, col, [0.5], {(col, 0.5): f"_med{i}"})
        meds.append(t.withColumnRenamed(k, f"_k{i}"))
    glob = percentile_table(df, [], col, [0.5], {(col, 0.5): "_medg"})
    out = df
    for i, (k, t) in enumerate(zip(group_keys, meds)):
        out = out.join(t, F.col(k) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
    out = attach_global(out, glob)
    out = out.withColumn(col, F.coalesce(F.col(col), *[F.col(f"_med{i}") for i in range(len(meds))], F.col("_medg")))
    return out.drop(*[f"_med{i}" for i in range(len(meds))], "_medg")


def impute_amounts(df: DataFrame, amounts: Sequence[str], flag: str, category: str) -> DataFrame:
    """Amounts: zero where ``flag``; missing -> median in ``category`` (zeros
    included) -> global median; zero where ``flag`` again. A row whose category is
    NULL goes straight to the global median."""
    out = df
    for c in amounts:
        out = out.withColumn(c, zero_under_flag(c, flag))
    by_cat = percentile_table(out.where(F.col(category).isNotNull()), category, amounts, [0.5],
                              {(c, 0.5): f"_cm_{c}" for c in amounts}).withColumnRenamed(category, "_cat")
    glob = percentile_table(out, [], amounts, [0.5], {(c, 0.5): f"_gm_{c}" for c in amounts})
    out = attach_global(out.join(by_cat, F.col(category) == F.col("_cat"), "left").drop("_cat"), glob)
    for c in amounts:
        out = out.withColumn(c, zero_under_flag(F.coalesce(F.col(c), F.col(f"_cm_{c}"), F.col(f"_gm_{c}")), flag))
    return out.drop(*[f"_cm_{c}" for c in amounts], *[f"_gm_{c}" for c in amounts])


def impute_bool_default(df: DataFrame, col: str, default: bool = False) -> DataFrame:
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(default)))
