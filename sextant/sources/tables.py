"""Scans and sinks: Parquet test tables, CSV with a declared schema, NaN ->
NULL at ingest, Parquet stage tables between steps, prediction output."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table (Parquet: column pruning and filters reach the scan)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN -> NULL in every floating column (Spark sorts NaN above all values
    and averages it; the source tables treat it as missing)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.when(F.isnan(f.name), F.lit(None).cast(f.dataType))
                        .otherwise(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str,
             header: bool = True) -> DataFrame:
    """CSV with a header and a declared schema (no inference pass over the
    data); an empty field is NULL, ``True``/``False`` parse as booleans."""
    df = (spark.read.schema(schema).option("header", str(header).lower())
          .option("mode", "PERMISSIVE").option("nanValue", "NaN").csv(path))
    return nan_to_null(df)


def write_stage(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                mode: str = "overwrite") -> DataFrame:
    """Materialise a stage table (features, fold predictions) as Parquet and
    return the re-read frame; lineage is cut and the files survive executor
    loss. ``path`` should be on shared storage."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def read_stage_models(spark: SparkSession, path: str, models: Sequence[str],
                      min_models: int = 2) -> DataFrame:
    """Per-model prediction table partitioned by ``model``: keep the models
    present, skip missing ones, require at least ``min_models``."""
    df = spark.read.parquet(path)
    present = [r[0] for r in df.select("model").distinct().where(F.col("model").isin(list(models))).collect()]
    if len(present) < min_models:
        raise ValueError(f"need at least {min_models} models, found {len(present)}")
    return df.where(F.col("model").isin(present))


def write_predictions(df: DataFrame, path: str, key: str, label: str, fmt: str = "csv") -> None:
    """Prediction output (key, boolean label) with a header."""
    out = df.select(key, F.col(label).cast("boolean").alias(label))
    if fmt == "csv":
        out.write.mode("overwrite").option("header", "true").csv(path)
    else:
        out.write.mode("overwrite").parquet(path)


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True,
                     bad: str = "_bad") -> DataFrame:
    """``read_csv`` with one more column, ``bad``: the raw line of a row that does not
    fit the schema (its other columns hold what could be parsed), NULL for good rows.
    No row is lost."""
    fields = (T._parse_datatype_string(schema) if isinstance(schema, str) else schema).fields
    full = T.StructType([*fields, T.StructField(bad, T.StringType())])
    rows = nan_to_null(spark.read.schema(full).option("header", str(header).lower()).option("mode", "PERMISSIVE")
                       .option("columnNameOfCorruptRecord", bad).option("nanValue", "NaN").csv(path))
    # a scan parses only the fields it is asked for: ask for all wherever ``bad`` is used
    every = F.xxhash64(*[F.col(f.name) for f in fields]) <= F.lit((1 << 63) - 1)
    return rows.withColumn(bad, F.when(every, F.col(bad)))


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> DataFrame:
    """Write ``df`` into a partitioned stage table: partitions that it holds are replaced,
    others stay (a run written again does not touch its neighbours). Returns the table."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))
    return df.sparkSession.read.parquet(path)
