"""Isotonic regression by pooling adjacent violators in two levels.

Rows are first counted per distinct score. The scores are range-partitioned, every
task pools its own range and passes on only the pooled blocks; one more task per fit
pools those. Pooling is associative over neighbouring ranges, so the blocks equal those
of one pass over all scores. A fitted curve is a short list of (score, value) points;
values between two points are interpolated, outside they are the end values."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .folds import exact_stratified_folds

BLOCK = "fit int, lo double, hi double, s double, n double"


def push(blocks: list, point) -> None:
    """Append a block [lo, hi, sum, weight] and pool it with those before it while
    their means do not rise."""
    blocks.append(list(point))
    while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
        _, hi, s, n = blocks.pop()
        blocks[-1][1] = hi
        blocks[-1][2] += s
        blocks[-1][3] += n


def _pooled(batches):
    """Pool the runs of equal ``fit`` of a sorted partition, as a stream: the blocks
    of a run are all that is held."""
    names = ["fit", "lo", "hi", "s", "n"]
    fit, blocks = None, []

    def emit():
        cols = list(zip(*blocks))
        return pa.RecordBatch.from_arrays([pa.array([fit] * len(blocks), pa.int32()), *map(pa.array, cols)], names=names)

    for batch in batches:
        for f, *point in zip(*(c.to_pylist() for c in batch.columns)):
            if f != fit and blocks:
                yield emit()
                blocks = []
            fit = f
            push(blocks, point)
    if blocks:
        yield emit()


def fit_curves(points: DataFrame) -> dict[int, list[tuple[float, float]]]:
    """{fit: curve} from (fit, x, s, n): per fit and distinct score the sum of labels and
    the number of rows."""
    ship(points.sparkSession)
    ranges = (points.select(F.col("fit").cast("int").alias("fit"), F.col("x").cast("double").alias("lo"),
                            F.col("x").cast("double").alias("hi"), F.col("s").cast("double").alias("s"),
                            F.col("n").cast("double").alias("n"))
              .repartitionByRange("fit", "lo").sortWithinPartitions("fit", "lo"))
    blocks = ranges.mapInArrow(_pooled, BLOCK)
    merged = blocks.repartition("fit").sortWithinPartitions("fit", "lo").mapInArrow(_pooled, BLOCK)
    curves: dict[int, list] = {}
    for r in merged.orderBy("fit", "lo").collect():         # the curve itself
        ends = [r.lo] if r.lo == r.hi else [r.lo, r.hi]
        curves.setdefault(r.fit, []).extend((x, r.s / r.n) for x in ends)
    return curves


def interpolate(x: Column, curve) -> Column:
    """The curve at ``x``. Points are grouped by the square root of their number, so a
    row looks at two short lists instead of all points."""
    if not curve:
        return F.lit(None).cast("double")
    size = max(1, int(len(curve) ** 0.5))
    groups = [curve[at:at + size] for at in range(0, len(curve), size)]
    starts = F.array(*[F.lit(float(g[0][0])) for g in groups])
    inside = F.array(*[F.array(*[F.lit(float(p)) for p, _ in g]) for g in groups])
    xs, ys = (F.array(*[F.lit(float(p[i])) for p in curve]) for i in (0, 1))
    g = F.greatest(F.size(F.filter(starts, lambda b: b <= x)), F.lit(1))
    at = (g - 1) * size + F.size(F.filter(F.element_at(inside, g), lambda b: b <= x))
    lo, hi = F.greatest(at, F.lit(1)), F.least(at + 1, F.lit(len(curve)))
    x0, x1, y0, y1 = F.element_at(xs, lo), F.element_at(xs, hi), F.element_at(ys, lo), F.element_at(ys, hi)
    slope = F.try_divide(y1 - y0, x1 - x0)
    return (F.when(x.isNull(), F.lit(None).cast("double")).when(at == 0, y0).when((lo == hi) | (x <= x0), y0)
            .when(x >= x1, y1).otherwise(y0 + slope * (x - x0)))


def calibration_curves(df: DataFrame, id_col: str, prob: str, label: str, k: int = 5, seed: int = 42,
                       digits: int | None = None) -> tuple[DataFrame, dict]:
    """(rows with their ``fold``, {fold: curve fitted on the other folds}). Folds are
    stratified by label. Rows without a score or label take no part in a fit. With
    ``digits`` scores are rounded first."""
    x = F.col(prob).cast("double") if digits is None else F.round(F.col(prob).cast("double"), digits)
    rows = exact_stratified_folds(df.select(id_col, F.col(label).cast("double").alias("_y"), x.alias("_x")),
                                  id_col, "_y", k, seed, out="fold")
    counted = (rows.where("_x is not null and _y is not null").groupBy("fold", "_x")
               .agg(F.sum("_y").alias("s"), F.count("*").alias("n")))
    others = F.filter(F.array(*[F.lit(f) for f in range(k)]), lambda f: f != F.col("fold"))
    points = (counted.select(F.explode(others).alias("fit"), F.col("_x").alias("x"), "s", "n")
              .groupBy("fit", "x").agg(F.sum("s").alias("s"), F.sum("n").alias("n")))
    return rows, fit_curves(points)


def own_fold_value(x: Column, fold: Column, curves: dict) -> Column:
    """Each row by the curve that has not seen its fold."""
    out = F.lit(None).cast("double")
    for f, curve in curves.items():
        out = F.when(fold == f, interpolate(x, curve)).otherwise(out)
    return out


def mean_value(x: Column, curves: dict) -> Column:
    """The mean of all curves, for rows outside the folds."""
    return sum((interpolate(x, c) for c in curves.values()), F.lit(0.0)) / F.lit(float(max(len(curves), 1)))
