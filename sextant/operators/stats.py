"""Fitted statistics as small tables, and the joins that apply them.

``fit`` side: one aggregate per statistic, keyed by the grouping columns.
Aggregates use partial (map-side) aggregation, so a hot key that holds a third
of all rows is pre-combined on every executor before the shuffle; only one
partial row per key and task crosses the network.

``apply`` side: a left equi join on the key (a NULL key never matches, the
same as a dictionary lookup of a missing key) followed by ``coalesce`` with a
default. Keyed statistic tables are left to AQE: once the aggregate stage has
run, its real size is known and AQE turns the join into a broadcast only when
it is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``; otherwise the
sort-merge join stays, and AQE's skew-join splits a hot key's partition.
Global (one-row) statistics are broadcast explicitly: their size is one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def mode_table(df: DataFrame, keys, col: str, out: str | None = None) -> DataFrame:
    """Most frequent non-null ``col`` per key; ties -> smallest value; keys whose
    values are all NULL are absent (a lookup then yields NULL).

    Two aggregates, both partial: (key, value) -> count, then per key the value
    with the smallest (-count, value). No per-key value list is ever built, so
    the state per key is O(1) however hot the key is.
    """
    keys = _keys(keys)
    out = out or f"{col}_mode"
    counts = (df.where(F.col(col).isNotNull())
                .groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_n")))
    return counts.groupBy(*keys).agg(
        F.min_by(F.col(col), F.struct((-F.col("_n")).alias("n"), F.col(col).alias("v"))).alias(out))


def global_mode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """One-row table with the column mode (ties -> smallest, NULL if none)."""
    out = out or f"{col}_mode"
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.min_by(F.col(col), F.struct((-F.col("_n")).alias("n"),
                                                     F.col(col).alias("v"))).alias(out))


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on ``keys`` in which NULL equals NULL; the keys appear once."""
    tagged = right.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in right.columns])
    if not keys:
        return left.crossJoin(F.broadcast(tagged))      # no key: one row
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(tagged, on).drop(*[f"_r_{k}" for k in keys])


def percentile_table(df: DataFrame, keys, cols, ps, names=None, n_chunks: int = 64) -> DataFrame:
    """Exact linear-interpolated percentiles of one or more columns per key (no
    key: one row); equal to Spark's ``percentile``. Columns are named
    ``names[(col, p)]`` (default ``{col}_q{j}``). NULL keys are a group.

    One path for every size, with bounded state per task and no job at plan time:
    counts per distinct value (partial aggregate); the values of each (key, column)
    are cut into ``n_chunks`` chunks at approximate quantiles (a mergeable sketch,
    which only decides how even the chunks are); the exact counts of the chunks
    tell which of them hold the wanted ranks, and only the values in those are
    ranked: about 1 / n_chunks of a group's distinct values per rank. However hot
    a key, its other values are only counted."""
    keys = _keys(keys)
    cols = [cols] if isinstance(cols, str) else list(cols)
    ps = [ps] if isinstance(ps, (int, float)) else list(ps)
    names = names or {}
    name = lambda c, j: names.get((c, ps[j]), f"{c}_q{j}")
    stacked = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(i).alias("_ci"), F.col(c).cast("double").alias("_v")) for i, c in enumerate(cols)])).alias("_s"))
    stacked = stacked.select(*keys, "_s._ci", "_s._v").where(F.col("_v").isNotNull())
    gk = keys + ["_ci"]
    vc = stacked.groupBy(*gk, "_v").agg(F.count(F.lit(1)).alias("_c"))
    t = _ranked_percentiles(vc, gk, ps, n_chunks)
    if len(cols) == 1:      # one column: no pivot (and no extra shuffle) needed
        out = t.select(*keys, *[F.col(f"_p{j}").alias(name(cols[0], j)) for j in range(len(ps))])
    else:
        wide = t.groupBy(*keys).pivot("_ci", list(range(len(cols)))).agg(
            *[F.first(f"_p{j}").alias(f"p{j}") for j in range(len(ps))])
        single = len(ps) == 1
        out = wide.select(*keys, *[F.col(f"{i}" if single else f"{i}_p{j}").alias(name(c, j))
                                   for i, c in enumerate(cols) for j in range(len(ps))])
    if not keys:
        # a global statistic is always one row (NULL when there is no value),
        # like a global aggregate, so attaching it never drops data rows
        out = one_row(out)
    return out


def _ranked_percentiles(vc: DataFrame, gk: list, ps, n_chunks: int) -> DataFrame:
    """Percentiles from (group, value, count) rows (see :func:`percentile_table`)."""
    grid = [k / n_chunks for k in range(1, n_chunks)]
    bnd = vc.groupBy(*gk).agg(F.array_distinct(F.percentile_approx("_v", grid, 10 * n_chunks)).alias("_b"))
    x = same_keys(vc, bnd, gk).withColumn("_chunk", F.size(F.filter("_b", lambda b: b < F.col("_v")))).drop("_b")
    ch = x.groupBy(*gk, "_chunk").agg(F.sum("_c").alias("_cc"))
    ch = ch.select(*gk, "_chunk", "_cc",        # at most n_chunks rows per group
                   (F.sum("_cc").over(Window.partitionBy(*gk).orderBy("_chunk")) - F.col("_cc")).alias("_off"),
                   F.sum("_cc").over(Window.partitionBy(*gk)).alias("_n"))
    ranks = []
    for p in ps:
        pos = (F.col("_n") - 1).cast("double") * F.lit(float(p))
        ranks += [F.floor(pos), F.ceil(pos)]
    holds = [(F.col("_off") <= r) & (r < F.col("_off") + F.col("_cc")) for r in ranks]
    wanted = ch.where(reduce(lambda a, b: a | b, holds)).drop("_cc")
    x = same_keys(x, wanted, gk + ["_chunk"])
    x = x.withColumn("_before", F.col("_off") + F.sum("_c").over(
        Window.partitionBy(*gk, "_chunk").orderBy("_v")) - F.col("_c"))
    here = [(F.col("_before") <= r) & (r < F.col("_before") + F.col("_c")) for r in ranks]
    t = x.groupBy(*gk).agg(F.first("_n").alias("_n"),
                           *[F.max(F.when(h, F.col("_v"))).alias(f"_r{i}") for i, h in enumerate(here)])
    outs = []
    for j, p in enumerate(ps):
        pos = (F.col("_n") - 1).cast("double") * F.lit(float(p))
        lo, hi = F.floor(pos), F.ceil(pos)
        vlo, vhi = F.col(f"_r{2 * j}"), F.col(f"_r{2 * j + 1}")
        val = (F.when((lo == hi) | (vlo == vhi), vlo)
                .otherwise((hi.cast("double") - pos) * vlo + (pos - lo.cast("double")) * vhi))
        outs.append(val.alias(f"_p{j}"))
    return t.select(*gk, *outs)


def lookup(df: DataFrame, table: DataFrame, keys, defaults: dict | None = None,
           salt: int | None = None) -> DataFrame:
    """Left equi join of a fitted table; unmatched rows take ``defaults``.

    ``salt=N`` spreads every key over N join partitions: the (one row per key)
    table is replicated N times with salt 0..N-1, each data row takes the salt
    hash(row) mod N. A key holding a third of the rows then lands in N tasks
    instead of one, without relying on AQE's skew split."""
    keys = _keys(keys)
    if salt and salt > 1:
        # any deterministic row hash will do: the salt never changes a result
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salt)))
        reps = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        out = salted.join(reps, on=keys + ["_salt"], how="left").drop("_salt")
        for c, d in (defaults or {}).items():
            out = out.withColumn(c, F.coalesce(F.col(c), d if isinstance(d, Column) else F.lit(d)))
        return out
    out = df.join(table, on=keys, how="left")
    for c, d in (defaults or {}).items():
        out = out.withColumn(c, F.coalesce(F.col(c), d if isinstance(d, Column) else F.lit(d)))
    return out


def one_row(table: DataFrame) -> DataFrame:
    """Exactly one row: the table's single row, or one row of NULLs when the
    table is empty (as a global aggregate over no values)."""
    return (table.sparkSession.range(1).select(F.lit(0).alias("_one"))
            .join(table.withColumn("_one", F.lit(0)), "_one", "left").drop("_one"))


def attach_global(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach a one-row statistic table to every row (broadcast: size is 1 row).
    This is the only cross product in the library besides fixed small grids:
    O(rows), never pairs of data rows (the plan is a broadcast nested loop
    join against one row)."""
    return df.crossJoin(F.broadcast(one_row))


def group_size_table(df: DataFrame, keys, out: str = "size") -> DataFrame:
    keys = _keys(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def distinct_count_table(df: DataFrame, keys, col: str, out: str) -> DataFrame:
    """Distinct non-null ``col`` values per key, as two aggregates (a
    DISTINCT window is not allowed, and one big per-key set is avoided)."""
    keys = _keys(keys)
    pairs = df.where(F.col(col).isNotNull()).select(*keys, col).distinct()
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def fill_from_table(df: DataFrame, col: str, table: DataFrame, keys, stat_col: str) -> DataFrame:
    """``col`` := coalesce(col, looked-up statistic)."""
    out = lookup(df, table, keys)
    return out.withColumn(col, F.coalesce(F.col(col), F.col(stat_col))).drop(stat_col)


def label_stats_table(df: DataFrame, keys, label: str, prefix: str = "grp") -> DataFrame:
    """mean / count / sum of the label per key (NULL labels skipped) and the
    agreement max(mean, 1 - mean)."""
    keys = _keys(keys)
    t = df.groupBy(*keys).agg(
        F.avg(label).alias(f"{prefix}_mean"),
        F.count(label).alias(f"{prefix}_count"),
        F.sum(label).cast("bigint").alias(f"{prefix}_sum"))
    m = F.col(f"{prefix}_mean")
    return t.withColumn(f"{prefix}_agreement", F.greatest(m, 1 - m))


def global_label_mean(df: DataFrame, label: str, out: str = "prior") -> DataFrame:
    return df.agg(F.avg(label).alias(out))


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Names of the numeric columns, from the schema (no data is read)."""
    from pyspark.sql.types import NumericType
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def numeric_matrix(df: DataFrame, keep: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns plus every numeric column, NULL -> 0."""
    cols = numeric_columns(df, list(exclude) + list(keep))
    return df.select(*keep, *cols).fillna(0, cols)
