import random

from cases import words
from test_jaccard import brute

import corpus_pipeline as C
from sextant.llm.common import staged


def test_stages_on_planted_cases(spark, tmp_path):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(150):
        w = words(rng, 60, 4000)
        toxic = i % 5 == 0
        if toxic:
            w[7] = "blockhead"
        docs.append([i, w, "s%d" % (i % 3)])
        labels.append((i, 1, int(toxic)))
    item = words(rng, 30, 4000)
    docs[1][1][5:5] = item[15:] + item[:15]
    docs += [[200, list(docs[2][1]), "s2"], [201, docs[3][1][:-1] + ["edit"], "s1"]]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(d, " ".join(w), "en", s, len(" ".join(w))) for d, w, s in docs] + [(None, None, None, None, None)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, " ".join(item))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    df, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in C.STAGES:
        df = staged(stage(spark, df, str(tmp_path)))
        seen[name] = [r.doc_id for r in df.select("doc_id").collect()]
    clean = {d for d, _, _ in docs} - {d for d, _, y in labels if y}
    assert set(seen["toxicity"]) == clean | {None}
    left = [(d, " ".join(w)) for d, w, _ in docs if d in clean]
    assert set(seen["ngram_jaccard_join"]) == {c for _, _, c in brute(left)} | {None}
    assert {200, 201} & set(seen["ngram_jaccard_join"]) == set()
    assert set(seen["decontamination"]) == set(seen["ngram_jaccard_join"]) - {1}
    words_in = sum(len(w) for d, w, _ in docs if d in set(seen["decontamination"]))
    words_out = sum(len(r.text.split()) for r in df.select("text").collect())
    assert abs(words_out - 1.5 * words_in) <= 3
    assert df.columns == ["doc_id", "text", "lang", "source", "n_chars", "slot", "shard"]
