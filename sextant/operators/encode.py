"""Label-aware and plain encoders: out-of-fold target encoding, ordinal codes,
TF-IDF terms, population scaling and a truncated SVD of term weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .sparse_svd import block_svd, pack
from .stats import attach_global, global_label_mean, lookup


def _prior(train: DataFrame, label: str, prior):
    return global_label_mean(train, label, "_prior") if prior is None else None


def target_encode_oof(train: DataFrame, cols: Sequence[str], label: str, fold: str,
                      smoothing: float = 10.0, prior: float | None = None,
                      prefix: str = "te_") -> DataFrame:
    """Smoothed target encoding where each row only sees the other folds.

    te = (S_other + m * g) / (N_other + m), S_other/N_other = label sum/count of
    the category outside the row's fold, g = mean of all train labels; a
    missing or unseen category gives g.

    One aggregate for all columns: (column, value, fold) -> sum, count over a
    stacked view, then the other-fold statistic is total - own fold (a window
    over at most k rows per category, on the small statistic table). The
    source's repeated per-fold group-bys (columns x folds scans) become one.
    """
    cols = list(cols)
    stacked = train.select(
        F.col(label).alias("_y"), F.col(fold).alias("_f"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("_c"), F.col(c).cast("string").alias("_v"))
                            for c in cols])).alias("_cv"))
    stats = (stacked.where(F.col("_cv._v").isNotNull())
                    .groupBy(F.col("_cv._c").alias("_c"), F.col("_cv._v").alias("_v"), "_f")
                    .agg(F.sum("_y").alias("_s"), F.count("_y").alias("_n")))
    w = Window.partitionBy("_c", "_v")
    stats = stats.select("_c", "_v", "_f",
                         (F.sum("_s").over(w) - F.col("_s")).alias("_so"),
                         (F.sum("_n").over(w) - F.col("_n")).alias("_no"))
    out = train
    if prior is None:
        out = attach_global(out, global_label_mean(train, label, "_prior"))
        g = F.col("_prior")
    else:
        g = F.lit(float(prior))
    for c in cols:
        t = stats.where(F.col("_c") == c).select(
            F.col("_v").alias(f"_v_{c}"), F.col("_f").alias(f"_f_{c}"),
            F.col("_so").alias(f"_so_{c}"), F.col("_no").alias(f"_no_{c}"))
        out = out.join(t, (out[c].cast("string") == t[f"_v_{c}"]) & (out[fold] == t[f"_f_{c}"]), "left")
        enc = (F.col(f"_so_{c}") + F.lit(smoothing) * g) / (F.col(f"_no_{c}") + F.lit(smoothing))
        out = out.withColumn(f"{prefix}{c}", F.coalesce(enc, g)).drop(
            f"_v_{c}", f"_f_{c}", f"_so_{c}", f"_no_{c}")
    return out.drop("_prior") if prior is None else out


def target_encode_full(train: DataFrame, apply_to: DataFrame, cols: Sequence[str], label: str,
                       smoothing: float = 10.0, prior: float | None = None,
                       prefix: str = "te_") -> DataFrame:
    """Smoothed target encoding fitted on all of ``train``, applied to
    ``apply_to`` (the unlabelled rows): (S + m g) / (N + m), unseen -> g."""
    out = apply_to
    if prior is None:
        out = attach_global(out, global_label_mean(train, label, "_prior"))
        g = F.col("_prior")
    else:
        g = F.lit(float(prior))
    for c in cols:
        t = (train.where(F.col(c).isNotNull()).groupBy(c)
                  .agg(F.sum(label).alias("_s"), F.count(label).alias("_n")))
        out = lookup(out, t, c)
        enc = (F.col("_s") + F.lit(smoothing) * g) / (F.col("_n") + F.lit(smoothing))
        out = out.withColumn(f"{prefix}{c}", F.coalesce(enc, g)).drop("_s", "_n")
    return out.drop("_prior") if prior is None else out


def ordinal_codes(df: DataFrame, col: str, missing: str = "__MISSING__",
                  n_buckets: int | None = None) -> DataFrame:
    """Vocabulary table (value, code): codes 0.. by code-point order of the text
    values, missing -> ``missing``.

    Distributed rank: the distinct values are range-partitioned by value
    (bounds from a sample, so buckets are balanced even when many values share
    a prefix, and bucket i holds only values below bucket i + 1); the code is
    the bucket's offset plus the rank inside the bucket. The only window
    without a partition key runs on the bucket-size table (n_buckets rows)."""
    n = n_buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    vals = df.select(F.coalesce(F.col(col).cast("string"), F.lit(missing)).alias("value")).distinct()
    vals = vals.repartitionByRange(n, "value").withColumn("_b", F.spark_partition_id()).persist()
    sizes = vals.groupBy("_b").agg(F.count(F.lit(1)).alias("_bn"))
    offs = sizes.select("_b", (F.sum("_bn").over(Window.orderBy("_b")) - F.col("_bn")).alias("_off"))
    ranked = vals.withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy("value")))
    return (ranked.join(offs, "_b")
                  .select("value", (F.col("_off") + F.col("_r") - 1).cast("int").alias("code")))


def ordinal_encode(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None,
                   missing: str = "__MISSING__", unknown: int = -1, suffix: str = "_code") -> DataFrame:
    """Replace each text column with its ordinal code (vocabulary from
    ``fit_on``, default ``df`` itself; unseen -> ``unknown``)."""
    fit_on = df if fit_on is None else fit_on
    out = df
    for c in cols:
        vocab = ordinal_codes(fit_on, c, missing).select(
            F.col("value").alias(f"_val_{c}"), F.col("code").alias(f"{c}{suffix}"))
        out = out.join(vocab, F.coalesce(out[c].cast("string"), F.lit(missing)) == vocab[f"_val_{c}"], "left")
        out = out.withColumn(f"{c}{suffix}", F.coalesce(F.col(f"{c}{suffix}"), F.lit(unknown))).drop(f"_val_{c}")
    return out


# Unicode word characters (letters, digits, underscore): ``\w`` would be ASCII
# only in the JVM, so the class is spelled out. Tokens have >= 2 characters.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
NON_TOKEN_PATTERN = r"[^\p{L}\p{N}_]+"


def _token_array(text: str):
    """Tokens of a text column as an array (same rule as ``tfidf_terms``)."""
    return F.filter(F.split(F.lower(F.col(text)), NON_TOKEN_PATTERN), lambda t: F.length(t) >= 2)


def _term_counts(docs: DataFrame, tokens: str) -> DataFrame:
    """(term, _cf, _df): occurrences and documents of each term of the array column
    ``tokens``, one document a row. A document's tokens are sorted inside the row and the
    first of each run counts as a document, so a task holds one entry per distinct term,
    never one per (document, term)."""
    words = docs.select(F.array_sort(tokens).alias("_s")).select(F.explode(F.transform(
        "_s", lambda t, i: F.struct(t.alias("term"), ((i == 0) | (F.get("_s", i - 1) != t)).cast("int").alias("first")))).alias("_w"))
    return words.groupBy(F.col("_w.term").alias("term")).agg(F.count(F.lit(1)).alias("_cf"), F.sum("_w.first").alias("_df"))


def _vocabulary(counts: DataFrame, docs: DataFrame, max_features: int | None, smooth: bool) -> DataFrame:
    """(term, idf) from a (term, _cf, _df) table: the ``max_features`` terms with
    the highest corpus frequency (ties by term); idf = ln((1 + n) / (1 + df)) + 1."""
    n_docs = docs.agg(F.count(F.lit(1)).alias("_nd"))
    vocab = counts
    if max_features is not None:
        vocab = vocab.orderBy(F.desc("_cf"), F.asc("term")).limit(max_features)
    vocab = attach_global(vocab, n_docs)
    idf = (F.ln((F.col("_nd") + 1) / (F.col("_df") + 1)) + 1) if smooth else (F.ln(F.col("_nd") / F.col("_df")) + 1)
    return vocab.select("term", idf.alias("idf"))


def tfidf_terms(df: DataFrame, id_col: str, text_col: str, max_features: int | None = 1000,
                smooth: bool = True, broadcast_terms: int = 100_000) -> DataFrame:
    """TF-IDF as a long table (id, term, tf, weight).

    lower-case; tokens = runs of >= 2 Unicode word characters; vocabulary =
    ``max_features`` terms with the highest corpus frequency (ties by term);
    idf = ln((1 + n) / (1 + df)) + 1; weights L2-normalised per document.
    Documents are hash-partitioned by id once (raw text is smaller than the
    (doc, term) rows it explodes into); token counts per (doc, term) and the
    per-document norm then run inside that partitioning with no further
    shuffle of document rows. The (doc, term) table is persisted because the
    vocabulary pass and the weighting pass both read it. The vocabulary is a
    top-k of the term table; with ``max_features`` up to ``broadcast_terms`` its
    size is bounded, so it is broadcast."""
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("_t")).repartition("id")
    # split at runs of non-word characters and keep tokens of >= 2 characters:
    # the same tokens as extracting TOKEN_PATTERN, about a fifth cheaper
    toks = (docs.select("id", F.explode(F.split(F.lower(F.col("_t")), NON_TOKEN_PATTERN)).alias("term"))
                .where(F.length("term") >= 2))
    tf = toks.groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf")).persist()
    counts = tf.groupBy("term").agg(F.sum("tf").alias("_cf"), F.count(F.lit(1)).alias("_df"))
    vocab = _vocabulary(counts, df, max_features, smooth)
    if max_features is not None and max_features <= broadcast_terms:
        vocab = F.broadcast(vocab)      # at most max_features rows
    w = tf.join(vocab, "term").withColumn("_raw", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy("id")))
    return w.select(F.col("id").alias(id_col), "term", "tf", "idf", (F.col("_raw") / norm).alias("weight"))


def standard_scale(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """(x - mean) / population std; a constant column becomes 0."""
    stats = df.agg(*[F.avg(c).alias(f"_mu_{c}") for c in cols],
                   *[F.stddev_pop(c).alias(f"_sd_{c}") for c in cols])
    out = attach_global(df, stats)
    for c in cols:
        sd = F.col(f"_sd_{c}")
        out = out.withColumn(f"{c}{suffix}", (F.col(c) - F.col(f"_mu_{c}")) /
                             F.when(sd == 0, F.lit(1.0)).otherwise(sd))
    return out.drop(*[f"_mu_{c}" for c in cols], *[f"_sd_{c}" for c in cols])


def text_svd(df: DataFrame, id_col: str, text_col: str, k: int = 5, max_features: int | None = 1000,
             smooth: bool = True) -> DataFrame:
    """Uncentred truncated SVD of the TF-IDF matrix: (id, svd_0..k-1) = rows of
    U * Sigma = A V, one row per document (zeros when it has no vocabulary term or no text).

    Above 20,000 terms, or with ``max_features=None`` (every term), the
    vocabulary stays distributed: ``sparse_svd.block_svd`` of the counts of
    terms, weighted as ``tfidf_terms`` does. Up to that many terms everything per document runs in the JVM:
      * the vocabulary and idf (at most ``max_features`` terms, a fitted
        constant) come to the driver;
      * ``CountVectorizerModel`` over the token array, ``ElementwiseProduct``
        with the idf and ``Normalizer`` build the sparse L2-normalised rows;
      * the vocabulary x vocabulary Gram matrix comes from distributed
        aggregates: ``Summarizer`` (count, mean, variance) and
        ``Correlation.corr``, combined as A^T A = (n - 1) Cov + n mu mu^T.
    Its top-k eigenvectors V are computed with numpy on the driver (bounded
    by the vocabulary, not the data); the projection is a per-document dot
    product with each column of V. Each component's sign is fixed so its
    largest loading is positive."""
    import numpy as np
    from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.stat import Correlation, Summarizer

    if max_features is None or max_features > 20_000:
        # a Gram matrix of max_features^2 doubles would not fit the driver
        return _text_svd_distributed(df, id_col, text_col, k, max_features, smooth)
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("_t")).repartition("id")
    counts = _term_counts(docs.select(_token_array("_t").alias("_toks")), "_toks")
    vocab = _vocabulary(counts, df, max_features, smooth).orderBy("term").collect()   # <= max_features rows
    names = [f"svd_{j}" for j in range(k)]
    if not vocab:
        return docs.select(F.col("id").alias(id_col), *[F.lit(0.0).alias(c) for c in names])
    terms, idf = [r["term"] for r in vocab], [float(r["idf"]) for r in vocab]
    x = docs.select("id", _token_array("_t").alias("_toks"))
    x = CountVectorizerModel.from_vocabulary(terms, inputCol="_toks", outputCol="_tf").transform(x)
    x = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="_tf", outputCol="_w").transform(x)
    x = Normalizer(p=2.0, inputCol="_w", outputCol="_v").transform(x).select("id", "_v").persist()
    summ = x.select(Summarizer.metrics("count", "mean", "variance").summary(F.col("_v")).alias("s")).first()["s"]
    n, mean, var = float(summ["count"]), summ["mean"].toArray(), summ["variance"].toArray()
    corr = np.nan_to_num(Correlation.corr(x, "_v").head()[0].toArray())   # constant columns -> 0
    sd = np.sqrt(np.maximum(var, 0.0))
    gram = (n - 1.0) * corr * np.outer(sd, sd) + n * np.outer(mean, mean)
    vals, vecs = np.linalg.eigh(gram)
    v = vecs[:, np.argsort(vals)[::-1][:k]]
    for j in range(v.shape[1]):
        if v[np.abs(v[:, j]).argmax(), j] < 0:
            v[:, j] = -v[:, j]
    arr = vector_to_array(F.col("_v"))
    dots = [F.aggregate(F.zip_with(arr, F.array(*[F.lit(float(a)) for a in v[:, j]]), lambda a, b: a * b),
                        F.lit(0.0), lambda acc, t: acc + t).alias(names[j]) for j in range(v.shape[1])]
    dots += [F.lit(0.0).alias(c) for c in names[v.shape[1]:]]
    return x.select(F.col("id").alias(id_col), *dots)


BLOCK_CHARS = 400_000_000      # text of a block of the distributed form


def _text_svd_distributed(df: DataFrame, id_col: str, text_col: str, k: int, max_features: int | None,
                          smooth: bool) -> DataFrame:
    """``text_svd`` without a limit on the vocabulary: the TF-IDF matrix of ``tfidf_terms`` as blocks of
    counts with the idf and the length of each document beside them, so no (document, term) row is shuffled."""
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("_t"))
    if not docs.groupBy("id").count().where("count > 1").isEmpty():       # texts of one id are one row
        docs = docs.groupBy("id").agg(F.concat_ws(" ", F.collect_list("_t")).alias("_t"))
    # few blocks: each brings its own vocabulary
    n = -(-(docs.agg(F.sum(F.length("_t"))).first()[0] or 1) // BLOCK_CHARS)
    blocks = pack(docs.repartition(n, "id")
                      .select(F.col("id").alias("row"), _token_array("_t").alias("columns")).where("size(columns) > 0"))
    counts = blocks.columns.select(F.col("column").alias("term"), F.col("cf").alias("_cf"), F.col("df").alias("_df"))
    vocab = _vocabulary(counts, df, max_features, smooth).select(F.col("term").alias("column"), F.col("idf").alias("weight"))
    scores, _, _ = block_svd(blocks, k, vocab, unit_rows=True)
    scores = scores.withColumnRenamed("row", "id")
    out = df.select(F.col(id_col).alias("id")).join(scores, "id", "left")
    return out.select(F.col("id").alias(id_col),
                      *[F.coalesce(F.get("v", F.lit(j)), F.lit(0.0)).alias(f"svd_{j}") for j in range(k)])
