"""Mixing sources to target weights.

Targets come from the source totals: each source gets its weight's share of the
mix, at most ``max_epochs`` times its size; what a full source cannot take goes
to the others by weight (water-filling, solved in closed form over the sorted
sources). Within a source, documents are ordered by a hash-random key; the
running sum of sizes says where the source's budget ends, and a budget above the
size repeats whole epochs. The document at the cut is taken in part, so the
budget is met to the word.

Running sums are distributed: keys are uniform, so their leading digits cut each
source into ranges of a bounded expected number of rows; ranges are summed,
their totals accumulated, and the running sum continues inside each range. A
source with a third of all rows is spread like any other. The number of ranges
follows the row count and does not change the result."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, small, staged, word_count


def source_targets(totals: DataFrame, weights: list[int], share: float, max_epochs: int) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per
    source. Sources in code-point order, NULL last, take ``weights`` in turn.
    One row per source, so ordering them in one task is bounded by their number."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.col("no") - 1, F.lit(len(weights))) + 1).cast("int"))
    t = (totals.withColumn("no", F.row_number().over(by_name)).withColumn("w", w)
         .withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size")))
    by_fill = Window.orderBy(F.col("cap") / F.col("w"), "no")
    everything = Window.partitionBy()
    t = (t.withColumn("full", F.sum("cap").over(by_fill) - F.col("cap"))
         .withColumn("rest", F.sum("w").over(everything) - F.sum("w").over(by_fill) + F.col("w"))
         .withColumn("goal", F.lit(float(share)) * F.sum("source_size").over(everything))
         .withColumn("level", (F.col("goal") - F.col("full")) / F.col("rest")))
    # the first source, in order of filling, that the common level does not fill
    open_at = F.when(F.col("cap") / F.col("w") >= F.col("level"), F.row_number().over(by_fill))
    t = t.withColumn("at", open_at)
    first = F.min(F.when(F.col("at").isNotNull(), F.struct("at", "level"))).over(everything)
    t = t.withColumn("lam", first["level"])
    return t.select("source", "source_size",
                    F.coalesce(F.least("cap", F.col("w") * F.col("lam")), F.col("cap")).alias("target"))


def _key(id_col: str, seed: str):
    return F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(seed)))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, max_epochs: int = 2,
                range_rows: int = 20_000, seed: str = "mix") -> DataFrame:
    """One row per input row: (doc_id, source, key, size, source_size, target, taken,
    copies, partial). ``taken`` = ``copies`` whole epochs of the document plus
    ``partial`` words of it at the cut.

    A NULL or blank text has size 0 and takes nothing; NULL is a source of its
    own. Rows with one id are documents of their own (ordered by key, id, size;
    full ties are alike). A NULL id has the key of an empty text. An empty table
    gives an empty result; a source of size 0 has target 0."""
    rows = staged(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                              word_count(text_col).alias("size"), _key(id_col, seed).alias("key")))
    n = rows.count()
    digits = min(8, math.ceil(math.log(n / range_rows, 16))) if n > range_rows else 1
    targets = staged(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")),
                                    list(weights), share, max_epochs))
    rows = rows.withColumn("rng", F.substring("key", 1, digits))
    ranges = rows.groupBy("source", "rng").agg(F.sum("size").alias("s"))
    upto = Window.partitionBy("source").orderBy("rng")
    base = ranges.select(F.col("source").alias("_bs"), F.col("rng").alias("_br"),
                         (F.sum("s").over(upto) - F.col("s")).alias("base"))
    inside = Window.partitionBy("source", "rng").orderBy("key", F.col("doc_id").asc_nulls_first(), "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    run = rows.withColumn("upto", F.sum("size").over(inside) - F.col("size"))
    t = small(targets).select(F.col("source").alias("_ts"), "source_size", "target")
    joined = (run.join(small(staged(base)), F.col("source").eqNullSafe(F.col("_bs")) & (F.col("rng") == F.col("_br")))
              .join(t, F.col("source").eqNullSafe(F.col("_ts"))))
    whole = F.floor(F.col("target"))
    copies = F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(F.lit(0))
    left = whole - F.col("copies") * F.col("source_size") - F.col("base") - F.col("upto")
    return (joined.withColumn("copies", copies.cast("long"))
            .withColumn("partial", F.greatest(F.lit(0), F.least(F.col("size"), left)).cast("long"))
            .select("doc_id", "source", "key", "size", "source_size", "target",
                    (F.col("copies") * F.col("size") + F.col("partial")).alias("taken"), "copies", "partial"))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  length_col: str | None = "n_chars", seed: str = "mix", **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: each row as often as its
    source's budget takes it; the document at the cut ends with its last taken
    word (its words joined by spaces, ``length_col`` updated). Words outside the
    budget, and rows without words, are not in the mix.

    The plan comes down to one cut per source (whole epochs, then every document
    up to a key), so texts are not shuffled. Rows that tie with the cut in id and
    size are all cut there."""
    plan = mix_sources(docs, id_col, text_col, source_col, seed=seed, **options)
    at = F.struct("key", F.col("doc_id").cast("string").alias("id"), "size")
    cuts = staged(plan.groupBy("source").agg(
        F.first("copies").alias("_copies"),
        F.max(F.when(F.col("partial") > 0, F.struct(at.alias("at"), "partial"))).alias("_cut")))
    cuts = small(cuts).select(F.col("source").alias("_ms"), "_copies", F.col("_cut.at").alias("_at"),
                              F.col("_cut.partial").alias("_part"))
    here = F.struct(_key(id_col, seed).alias("key"), F.col(id_col).cast("string").alias("id"),
                    word_count(text_col).alias("size"))
    marked = docs.join(cuts, F.col(source_col).cast("string").eqNullSafe(F.col("_ms"))).withColumn("_here", here)
    more = F.when(F.col("_at").isNotNull() & (F.col("_here") <= F.col("_at")), F.lit(1)).otherwise(F.lit(0))
    marked = marked.where(F.col("_here.size") > 0).withColumn("_more", more)
    nth = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies") + F.col("_more"))).alias("_nth")
    rows = marked.where(F.col("_copies") + F.col("_more") > 0).select("*", nth)
    cut = ((F.col("_nth") > F.col("_copies")) & (F.col("_here") == F.col("_at")) & (F.col("_part") < F.col("_here.size")))
    words = F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0))
    text = F.when(cut, F.array_join(F.slice(words, F.lit(1), F.col("_part").cast("int")), " ")).otherwise(F.col(text_col))
    rows = rows.withColumn("_text", text)
    out = []
    for c in docs.columns:
        if c == text_col:
            out.append(F.col("_text").alias(c))
        elif c == length_col:
            out.append(F.when(cut, F.length("_text").cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return rows.select(*out)
