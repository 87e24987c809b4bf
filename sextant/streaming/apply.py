"""Stream-static application of fitted tables (no streaming state)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.stats import lookup


def apply_lookups(stream: DataFrame, fitted: Sequence[tuple[DataFrame, Sequence[str], dict]]) -> DataFrame:
    """Apply (table, keys, defaults) lookups to a streaming (or batch) frame.
    Each is a stream-static left join, which Structured Streaming runs per
    micro-batch without keeping state."""
    out = stream
    for table, keys, defaults in fitted:
        out = lookup(out, table, list(keys), defaults)
    return out


def scores_to_predictions(stream: DataFrame, prob: str, threshold: float | DataFrame,
                          lock: str | None = None, out: str = "prediction") -> DataFrame:
    """Decision p >= t (t a number or a one-row fitted table with column
    ``threshold``), a lock column overriding it when present."""
    if isinstance(threshold, DataFrame):
        stream = stream.crossJoin(F.broadcast(threshold.select("threshold")))
        t = F.col("threshold")
    else:
        t = F.lit(float(threshold))
    pred = (F.col(prob) >= t).cast("int")
    if lock is not None:
        pred = F.coalesce(F.col(lock), pred)
    res = stream.withColumn(out, pred)
    return res.drop("threshold") if isinstance(threshold, DataFrame) else res
