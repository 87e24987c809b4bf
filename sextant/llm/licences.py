"""Licence scans: sparse TF-IDF cosine to templates, then inheritance by path.

Templates are short notices, identifier lines, header blocks and whole licences. The
pieces of a text are its windows of 1, 3, 6, 12 and 24 neighbouring lines and the whole
text; pieces and templates are TF-IDF vectors, with document frequencies of all terms
counted over all documents. A text whose best piece is at ``threshold`` or more of a
template carries that licence. It is a licence file if its whole text is near its
licence, or if its file name says so: its directory and everything below it without a
licence of its own inherits, from the nearest such directory, by an equi-join of
ancestor paths.

Pieces that hold none of the templates' telling terms are left out before their terms
are counted. That is exact: by Cauchy-Schwarz the cosine of such a piece is under the
threshold for every template.

All of it is DataFrame functions. The templates are a parameter (some dozens of texts);
only their terms' counts reach the driver."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small, staged
from .licence_texts import standard_templates

#: Numbers of neighbouring lines that are compared as one piece.
WINDOWS = (1, 3, 6, 12, 24)
#: Names (lower case) of files that hold the licence of their directory.
FILE_NAME = "^(licen[cs]e|copying|unlicen[cs]e)"
# an identifier line is one term, so that an unknown identifier is near no template
TERM = "spdx-license-identifier: [a-z0-9]+(?:[.-][a-z0-9]+)*[+]?|[a-z0-9]+(?:[.-][a-z0-9]+)*"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms(text: Column) -> Column:
    """Terms of a text: letters and digits, joined by single dots or hyphens, or a whole
    identifier line."""
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(TERM), F.lit(0))


def _common_terms(vectors: list[dict[str, float]], idf: dict[str, float], threshold: float) -> set[str]:
    """Terms that alone never lift a piece to the threshold, most frequent first."""
    out: set[str] = set()
    for t in sorted(idf, key=lambda t: (idf[t], t)):
        more = out | {t}
        if all(math.sqrt(sum(x * x for u, x in v.items() if u in more)) <
               0.999 * threshold * math.sqrt(sum(x * x for x in v.values())) for v in vectors):
            out = more
    return out


def _literal(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A few rows as a table that the JVM makes from one literal."""
    made = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1).select(F.explode(made).alias("r")).select("r.*")


def _windows(some: DataFrame, telling: Column) -> DataFrame:
    """(key, size, line, own) of the windows that hold a telling term, and of the whole
    texts (size 0). ``some``: (key, text)."""
    lines = some.select("key", F.split("text", "\n", -1).alias("ls"))
    lines = lines.withColumn("hit", F.transform("ls", lambda x: F.arrays_overlap(terms(x), telling)))
    out = some.select("key", F.lit(0).alias("size"), F.lit(0).alias("line"), terms(F.col("text")).alias("own"))
    for size in WINDOWS:
        width = F.lit(size)
        first = F.when(F.size("ls") >= size, F.sequence(F.lit(1), F.size("ls") - (size - 1)))
        told = F.filter(first, lambda i: F.array_contains(F.slice("hit", i, width), True))
        at = lines.select("key", "ls", F.explode(told).alias("line"))
        body = F.array_join(F.slice("ls", F.col("line"), F.lit(size)), "\n")
        out = out.unionByName(at.select("key", F.lit(size).alias("size"), "line", terms(body).alias("own")))
    return out


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "path",
                  templates: list[tuple[str, str]] | None = None, threshold: float = 0.7,
                  file_threshold: float = 0.4) -> DataFrame:
    """(doc_id, path, licence, origin, score) per input row. ``origin`` is ``own`` (score:
    the best piece's cosine), ``inherited`` (score: that of the licence file) or ``none``
    (licence and score NULL). Ties go to the name that sorts first; the nearest
    directory wins, within it the best file. ``templates``: (licence, text) pairs.

    NULL, empty and blank texts have no licence of their own and may inherit. A NULL
    path neither gives nor inherits. Texts of any length are compared whole and in every
    window. Repeated rows get equal results. Other columns are ignored, whatever their
    names. An empty table gives an empty result."""
    templates = standard_templates() if templates is None else list(templates)
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(path_col).cast("string").alias("path"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    texts = _literal(spark, [{"tpl": i, "text": text} for i, (_, text) in enumerate(templates)], "tpl:int, text:string")
    made = [(r.tpl, r.term, r.tf) for r in texts.select("tpl", F.explode(terms(F.col("text"))).alias("term"))
            .groupBy("tpl", "term").agg(F.count("*").alias("tf")).collect()]     # the templates' terms
    vocab = sorted({t for _, t, _ in made})
    # the empty term counts the documents
    dfs = staged(src.select(F.explode(F.concat(F.array(F.lit("")), F.array_distinct(terms(F.col("text"))))).alias("term"))
                 .groupBy("term").agg(F.count("*").alias("df")))
    df = {r.term: r.df for r in dfs.where(F.col("term").isin("", *vocab)).collect()}   # at most one row per template term
    n = df.pop("", 0)
    idf = {t: math.log((1 + n) / (1 + df.get(t, 0))) + 1 for t in vocab}
    vectors: list[dict[str, float]] = [{} for _ in templates]
    for i, t, tf in made:
        vectors[i][t] = tf * idf[t]
    common = _common_terms(vectors, idf, threshold)
    telling = F.array(*[F.lit(t) for t in vocab if t not in common])
    tw = _literal(spark, [{"tpl": i, "name": templates[i][0], "term": t, "wt": x, "nt": math.sqrt(sum(y * y for y in v.values()))}
                          for i, v in enumerate(vectors) for t, x in v.items()],
                  "tpl:int, name:string, term:string, wt:double, nt:double")

    keyed = src.withColumn("key", F.xxhash64("doc_id", "path", "text"))
    some = staged(keyed.where(F.arrays_overlap(terms(F.col("text")), telling)).select("key", "path", "text"))
    piece = ["key", "size", "line"]
    tf = (_windows(some.select("key", "text").distinct(), telling).select(*piece, F.explode("own").alias("term"))
          .groupBy(*piece, "term").agg(F.count("*").alias("tf")))
    # most terms stand in one document only: those are left out of the join
    w = staged(tf.join(dfs.where("df > 1"), "term", "left")
               .withColumn("w", F.col("tf") * (F.log(F.lit(1.0 + n) / (1 + F.coalesce("df", F.lit(1)))) + 1)).select(*piece, "term", "w"))
    norm = w.groupBy(*piece).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("nl"))
    dot = w.join(F.broadcast(tw), "term").groupBy(*piece, "tpl", "name", "nt").agg(F.sum(F.col("w") * F.col("wt")).alias("dot"))
    cos = staged(dot.join(norm, piece).select("key", "size", "name", F.round(F.col("dot") / (F.col("nl") * F.col("nt")), 9).alias("cos"))
                 .where(F.col("cos") >= min(threshold, file_threshold)))
    best = (cos.where(F.col("cos") >= threshold)
            .groupBy("key").agg(F.min(F.struct((-F.col("cos")).alias("lo"), "name")).alias("b"))
            .select("key", F.col("b.name").alias("name"), (-F.col("b.lo")).alias("score")))
    best = staged(best)
    whole = cos.where((F.col("size") == 0) & (F.col("cos") >= file_threshold)).select("key", "name").distinct()
    folder = F.regexp_replace("path", "/?[^/]*$", "")
    base = F.regexp_extract("path", "[^/]*$", 0)
    files = (some.where(F.col("path").isNotNull()).select("key", "path").distinct().join(small(best), "key")
             .join(whole.withColumn("near", F.lit(True)), ["key", "name"], "left")
             .where(F.col("near") | F.lower(base).rlike(FILE_NAME)).select(folder.alias("dir"), "name", "score"))
    dirs = staged(files.groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("lo"), "name")).alias("b"))
                  .select("dir", F.col("b.name").alias("dname"), (-F.col("b.lo")).alias("dscore")))
    names_only = keyed.select("doc_id", "path", "key").join(small(best), "key", "left")
    parts = F.split("path", "/")
    depths = F.sequence(F.lit(0), F.size(parts) - 1)
    above = F.transform(depths, lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(parts, F.lit(1), i), "/").alias("dir")))
    heirs = (names_only.where(F.col("name").isNull() & F.col("path").isNotNull()).select("path").distinct()
             .select("path", F.explode(above).alias("a")).select("path", "a.depth", "a.dir")
             .join(small(dirs), "dir").groupBy("path")
             .agg(F.max(F.struct("depth", "dname", "dscore")).alias("h"))
             .select(F.col("path").alias("_hp"), F.col("h.dname").alias("dname"), F.col("h.dscore").alias("dscore")))
    out = names_only.join(heirs, F.col("name").isNull() & (F.col("path") == F.col("_hp")), "left")
    return out.select("doc_id", "path", F.coalesce("name", "dname").alias("licence"),
                      F.when(F.col("name").isNotNull(), "own").when(F.col("dname").isNotNull(), "inherited")
                      .otherwise("none").alias("origin"), F.coalesce("score", "dscore").alias("score"))
