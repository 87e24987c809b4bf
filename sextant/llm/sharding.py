"""Sharding by a permutation-filled lookup table.

Every shard has a preference order over the slots of a table of prime size:
``offset + j * skip`` modulo the size, which visits each slot once. Shards take
turns claiming their next free preferred slot until the table is full, so each
owns an equal share (to one slot) and adding or removing a shard moves few
slots. A document's slot is its id's hash modulo the size; the table has a fixed
number of rows and is broadcast, so placement is one constant-time lookup.

Everything that touches rows is DataFrame functions."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _h32(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def fill_table(shards: list[str], size: int) -> list[int]:
    """The owner (index into ``shards``) of each of ``size`` slots. The names are
    distinct; ``size`` is prime and at least their number."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be distinct and at least one")
    if not is_prime(size) or size < len(shards):
        raise ValueError("the table size must be prime and at least the number of shards")
    offset = [_h32(f"{s}:offset") % size for s in shards]
    skip = [_h32(f"{s}:skip") % (size - 1) + 1 for s in shards]
    at = [0] * len(shards)
    owner = [-1] * size
    for turn in range(size):
        s = turn % len(shards)
        while owner[slot := (offset[s] + at[s] * skip[s]) % size] >= 0:
            at[s] += 1
        owner[slot] = s
    return owner


def table_frame(spark: SparkSession, shards: list[str], size: int) -> DataFrame:
    """(slot, shard) with one row per slot, as a literal relation."""
    text = "[" + ",".join(map(str, fill_table(shards, size))) + "]"
    one = spark.range(1).select(F.from_json(F.lit(text), "array<int>").alias("o"))
    return one.select(F.posexplode("o").alias("slot", "shard"))


def slot_of(id_col: str, size: int) -> Column:
    """Slot of an id: leading 32 bits of the md5 of its text, modulo ``size``."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % F.lit(size)).cast("int")


def place(docs: DataFrame, shards: list[str], size: int, id_col: str = "doc_id",
          slot_name: str = "slot", shard_name: str = "shard") -> DataFrame:
    """``docs`` with its slot and shard (index into ``shards``).

    A NULL id is placed like an empty text; repeated ids go to one shard. All
    columns and rows of ``docs`` stay; columns already named like the two new
    ones are replaced. An empty table stays empty."""
    keep = [c for c in docs.columns if c.lower() not in (slot_name.lower(), shard_name.lower())]
    table = table_frame(docs.sparkSession, shards, size).select(
        F.col("slot").alias("_slot"), F.col("shard").alias("_shard"))
    placed = docs.select(*[F.col(f"`{c}`") for c in keep], slot_of(id_col, size).alias("_place"))
    return (placed.join(F.broadcast(table), F.col("_place") == F.col("_slot"))
            .select(*[F.col(f"`{c}`") for c in keep], F.col("_place").alias(slot_name),
                    F.col("_shard").alias(shard_name)))
