"""Language identification as multilingual mixture inference.

Each language is a distribution over character n-grams (hashed to a fixed number
of buckets), learned from a bounded sample of labelled documents. A document is
a mixture of languages: expectation-maximisation estimates the proportions that
make its n-grams likeliest. The set of languages is chosen by penalised
likelihood: starting from all, the weakest is dropped as long as that costs
fewer log-likelihood units than the penalty a language must earn."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, ship, small, staged

BUCKETS = 1 << 15
_LETTER = re.compile(r"[^\W\d_]")
_TABLE: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Per code point: itself if a letter or mark, else 0."""
    if not _TABLE:
        t = np.zeros(0x110000, dtype=np.uint32)
        for lo in range(0, 0x110000, 0x1000):
            for c in range(lo, lo + 0x1000):
                if unicodedata.category(chr(c))[0] in "LM":
                    t[c] = c
        _TABLE.append(t)
    return _TABLE[0]


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the character 1-, 2- and 3-grams of the letters of a
    text, in lower case; runs of anything else are one border mark."""
    raw = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    a = np.zeros(len(raw) + 2, dtype=np.uint32)
    a[1:-1] = _letter_table()[np.minimum(raw, 0x10FFFF)]
    keep = np.ones(len(a), dtype=bool)
    keep[1:] = (a[1:] != 0) | (a[:-1] != 0)
    a = a[keep].astype(np.uint64)
    if len(a) < 3:
        return np.zeros(0, dtype=np.int64), np.zeros(0)
    with np.errstate(over="ignore"):
        one = a[a > 0]
        two = a[:-1] * np.uint64(0x9E3779B97F4A7C15) + a[1:] + np.uint64(1 << 40)
        three = (a[:-2] * np.uint64(0xC2B2AE3D27D4EB4F) + a[1:-1]) * np.uint64(0x165667B19E3779F9) + a[2:] + np.uint64(1 << 50)
        h = np.concatenate([one, two, three]) * np.uint64(0xFF51AFD7ED558CCD)
    b = (h >> np.uint64(64 - 15)).astype(np.int64)
    n = np.bincount(b, minlength=BUCKETS)
    hit = np.flatnonzero(n)
    return hit, n[hit].astype(np.float64)


def training_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    held_out_mod: int = 5, per_language: int = 3_000) -> DataFrame:
    """(text, lang) of about ``per_language`` documents at most of each language,
    chosen by a hash of the id, whole texts; ids whose crc32 modulo
    ``held_out_mod`` is 0 and NULL languages, ids or texts are left out."""
    d = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    d = d.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_mod("_id", held_out_mod) != 0))
    size = staged(d.groupBy("lang").agg(F.count("*").alias("m")))
    key = F.pmod(F.xxhash64("_id", F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (d.join(small(size.withColumnRenamed("lang", "_l")), F.col("lang") == F.col("_l"))
            .where(key * F.col("m") < per_language).select("text", "lang"))


def fit(sample: DataFrame, smooth: float = 0.5) -> dict:
    """Language names and log-probabilities (languages, buckets). The counts that
    reach the driver are bounded by languages times buckets."""
    ship(sample.sparkSession)

    def count(batches):
        have: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                b, n = ngram_counts(text)
                # every document weighs the same: a long one must not set a language's profile
                own = have.setdefault(lang, np.zeros(BUCKETS))
                own[b] += n / max(1.0, n.sum()) * min(3000.0, n.sum())
        for lang, own in sorted(have.items()):
            hit = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(hit), pa.string()), pa.array(hit.astype(np.int32)), pa.array(own[hit])],
                names=["lang", "bucket", "n"])
    rows = (sample.mapInArrow(count, "lang string, bucket int, n double").groupBy("lang", "bucket")
            .agg(F.round(F.sum("n"), 3).alias("n")).groupBy("lang")
            .agg(F.collect_list("bucket").alias("b"), F.collect_list("n").alias("n")).orderBy("lang").collect())
    logp = np.full((len(rows), BUCKETS), smooth)
    for i, r in enumerate(rows):
        logp[i, np.asarray(r.b, dtype=np.int64)] += np.asarray(r.n)
    logp = np.log(logp / logp.sum(axis=1, keepdims=True)) if len(rows) else logp
    return {"langs": [r.lang for r in rows], "logp": logp.astype(np.float32)}


def mixture(p: np.ndarray, n: np.ndarray, start: np.ndarray, rounds: int = 12, settle: float = 1e-3):
    """EM for the proportions of the columns of ``p`` (n-grams, languages) given
    counts ``n``: (proportions, log-likelihood)."""
    pi, total = start / start.sum(), n.sum()
    for _ in range(rounds):
        mix = p @ pi
        new = pi * ((n / mix) @ p) / total
        done = np.abs(new - pi).max() < settle
        pi = new
        if done:
            break
    return pi, float(n @ np.log(p @ pi))


def infer(model_p: np.ndarray, buckets: np.ndarray, n: np.ndarray, penalty: float = 3.0,
          scale: float = 0.1) -> np.ndarray:
    """Proportions of the selected languages. ``model_p`` (buckets, languages).
    Neighbouring n-grams overlap, so log-likelihoods are scaled down by ``scale``
    before a language has to earn ``penalty`` plus half the log of the sample."""
    p = model_p[buckets]
    m = p.shape[1]
    cost = penalty + 0.5 * np.log(max(2.0, scale * n.sum()))
    pi, ll = mixture(p, n, np.ones(m))
    live = np.arange(m)
    while len(live) > 1:
        k = int(np.argmin(pi))
        keep = np.delete(np.arange(len(live)), k)
        sub = p[:, live[keep]]
        pi2, ll2 = mixture(sub, n, np.maximum(pi[keep], 1e-3))
        if scale * (ll - ll2) > cost:
            break
        live, pi, ll = live[keep], pi2, ll2
    out = np.zeros(m)
    out[live] = pi
    return out


def identify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, mixture) per input row: the language with the
    largest proportion (ties to the name that sorts first), that proportion, and
    the proportions of all selected languages. A text that is NULL or has no
    letter, or a model without languages, gives ``und`` with score 0 and an empty
    mixture. Repeated rows get equal results; other columns are ignored; an empty
    table gives an empty result."""
    ship(docs.sparkSession)
    langs = model["langs"]

    def run(batches):
        p = np.exp(model["logp"].astype(np.float64)).T.copy()
        for batch in batches:
            ids, preds, scores, mixes = batch.column(0), [], [], []
            for text in batch.column(1).to_pylist():
                b, n = ngram_counts(text) if langs and text and _LETTER.search(text) else (np.zeros(0), np.zeros(0))
                if not len(b):
                    preds.append("und")
                    scores.append(0.0)
                    mixes.append([])
                    continue
                pi = infer(p, b, n)
                k = int(np.argmax(pi))
                preds.append(langs[k])
                scores.append(float(min(1.0, max(0.0, pi[k]))))
                mixes.append([(langs[j], float(pi[j])) for j in np.argsort(-pi, kind="stable") if pi[j] > 0])
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(preds, pa.string()), pa.array(scores, pa.float64()),
                 pa.array([[{"lang": x, "share": s} for x, s in m] for m in mixes],
                          pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))],
                names=["doc_id", "lang_pred", "score", "mixture"])
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, lang_pred string, score double, mixture array<struct<lang:string,share:double>>")


def identify_languages(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, mixture) per input row, with a model
    learned from the documents whose crc32(id) mod 5 is not 0. A row with a NULL id
    counts as held out (it is never learned from)."""
    model = fit(training_sample(docs))
    out = identify(docs, model)
    return out.select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(True)).alias("held_out"),
                      "lang_pred", "score", "mixture")
