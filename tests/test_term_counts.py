"""Corpus counts of terms against a plain tally."""
import random
from collections import Counter

from pyspark.sql import functions as F

from sextant.operators import encode


def test_term_counts_equal_a_tally_and_hold_one_entry_a_term(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["red", "ring", "bolt", "a", "Nut", "Ärger", "x1_2"], k=rng.randint(1, 30))) for _ in range(60)] + ["", None, "-- ,"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, _t string")
    out = encode._term_counts(df.select(encode._token_array("_t").alias("toks")), "toks")
    words = [[w for w in (t or "").lower().replace("-", " ").replace(",", " ").split() if len(w) > 1] for t in texts]
    cf, docs = Counter(w for ws in words for w in ws), Counter(w for ws in words for w in set(ws))
    assert {r.term: (r._cf, r._df) for r in out.collect()} == {w: (cf[w], docs[w]) for w in cf}


def test_text_svd_does_not_aggregate_by_document(spark, monkeypatch):
    plans, vocabulary = [], encode._vocabulary
    monkeypatch.setattr(encode, "_vocabulary", lambda t, *rest: plans.append(t._jdf.queryExecution().optimizedPlan().toString()) or vocabulary(t, *rest))
    df = spark.createDataFrame([(1, "red ring"), (2, "red bolt")], "id int, text string")
    out = encode.text_svd(df, "id", "text", 2, 1000)
    assert out.count() == 2 and out.columns == ["id", "svd_0", "svd_1"]
    assert plans and all("Aggregate [id" not in p for p in plans)
