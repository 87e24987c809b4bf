"""Small frames shared by the operator tests."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocab=400):
    return [f"w{rng.randrange(vocab)}" for _ in range(n)]


def edge_docs(spark):
    """NULLs in every column, empty and blank texts, a very long text, repeated rows."""
    rng = random.Random(5)
    long = " ".join(words(rng, 30_000, 5000))
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4), (None, "one two", None, "b", 7),
            (4, long, "en", "a", len(long)), (5, "x y z", "en", "b", 5), (5, "x y z", "en", "b", 5),
            (6, "ünï çödé — 漢字", "fr", None, 14), (None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def clashing(df):
    """The same rows with extra columns named like an operator's own."""
    from pyspark.sql import functions as F
    for c in ("n", "f1", "key", "score", "size", "target", "slot", "shard", "frag", "sig", "path", "component_id", "words", "v"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit("extra"))
    return df


def rows(df, *cols):
    out = [tuple(r) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is not None, str(x)) for x in t))
