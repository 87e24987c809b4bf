"""The corpus pipeline: five stages over ``documents``, each one operator of
``sextant.llm``. A stage gets what its predecessor kept, as a table, and returns a
DataFrame with the same columns (the last one adds slot and shard)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sextant.llm.bindings import SHARDS, TABLE_SIZE
from sextant.llm.common import documents, staged
from sextant.llm.jaccard import one_per_group
from sextant.llm.mixing import mix_documents
from sextant.llm.sharding import place
from sextant.llm.tiling import drop_contaminated
from sextant.llm.toxicity import fit, keep_clean, training_sample
from sextant.sources.tables import read_table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more leave."""
    model = fit(training_sample(docs, read_table(spark, sf_dir, "labels")))
    return keep_clean(docs, model, threshold=0.7)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at Jaccard 0.8 of 5-word n-grams stays."""
    return one_per_group(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark item leave."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources to target weights: rows repeat by epochs, the last one is cut."""
    return mix_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets its slot and shard."""
    return place(docs, SHARDS, TABLE_SIZE)


STAGES = [("toxicity", toxicity), ("ngram_jaccard_join", near_duplicates), ("decontamination", decontamination),
          ("mixing", mixing), ("sharding", sharding)]

# the toxicity model is fitted, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
