import random

import pytest
from cases import DOCS, clashing, edge_docs, rows

from sextant.llm import mixing as M
from sextant.llm import sharding as S


def corpus(spark, n=600):
    rng = random.Random(2)
    r = [(i, " ".join(["w"] * rng.randrange(0, 40)), "en", "hot" if i % 3 == 0 else f"s{i % 7}", 0) for i in range(n)]
    return spark.createDataFrame(r, DOCS)


def fill(caps, weights, goal):
    """Water-filling by repeated resharing."""
    out, live = [0.0] * len(caps), set(range(len(caps)))
    while live:
        w = sum(weights[i] for i in live)
        left = goal - sum(out[i] for i in range(len(caps)) if i not in live)
        over = [i for i in live if left * weights[i] / w > caps[i]]
        if not over:
            for i in live:
                out[i] = left * weights[i] / w
            break
        for i in over:
            out[i] = float(caps[i])
            live.discard(i)
    return out


def test_targets_and_budgets(spark):
    got = M.mix_sources(corpus(spark), range_rows=20).toPandas()
    src = sorted(got.source.unique())
    size = [int(got[got.source == s]["size"].sum()) for s in src]
    want = fill([2 * x for x in size], [(5, 2, 1)[i % 3] for i in range(len(src))], 1.5 * sum(size))
    for s, x, t in zip(src, size, want):
        part = got[got.source == s]
        assert part.target.iloc[0] == pytest.approx(t)
        assert part.taken.sum() == int(part.target.iloc[0])
        assert (part.source_size == x).all()
        assert part.taken.le(2 * part["size"]).all()


def test_ranges_do_not_change_the_mix(spark):
    a = rows(M.mix_sources(corpus(spark), range_rows=10), "doc_id", "taken")
    assert a == rows(M.mix_sources(corpus(spark).repartition(7)), "doc_id", "taken")


def test_mixed_documents_hold_the_taken_words(spark):
    docs = clashing(corpus(spark))
    plan = M.mix_sources(docs).toPandas()
    mix = M.mix_documents(docs)
    assert mix.columns == docs.columns
    got = mix.withColumn("k", M.word_count("text")).groupBy("doc_id").sum("k").toPandas()
    have = dict(zip(got.doc_id, got["sum(k)"]))
    for d, t in zip(plan.doc_id, plan.taken):
        assert have.get(d, 0) == t


def test_mixing_edge_rows(spark):
    got = M.mix_sources(clashing(edge_docs(spark)))
    assert got.count() == 9
    assert got.where("size = 0 and taken <> 0").count() == 0
    assert got.where("source is null").agg({"taken": "sum"}).first()[0] >= 0
    M.mix_documents(clashing(edge_docs(spark))).count()
    none = spark.createDataFrame([], DOCS)
    assert M.mix_sources(none).count() == 0 and M.mix_documents(none).count() == 0


def test_table_is_balanced_and_stable():
    names = [f"s{i}" for i in range(10)]
    t = S.fill_table(names, 1009)
    counts = [t.count(i) for i in range(10)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == 1009
    less = S.fill_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(t, less) if a != 9)
    assert moved < 0.1 * 1009
    for bad in ((["a", "a"], 7), (["a"], 8), ([], 7), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            S.fill_table(*bad)


def test_turns_match_a_plain_simulation():
    names, size = ["x", "y", "z"], 31
    pref = []
    for n in names:
        o, k = S._h32(f"{n}:offset") % size, S._h32(f"{n}:skip") % (size - 1) + 1
        pref.append([(o + j * k) % size for j in range(size)])
        assert sorted(pref[-1]) == list(range(size))
    owner = {}
    for turn in range(size):
        owner[next(s for s in pref[turn % 3] if s not in owner)] = turn % 3
    assert S.fill_table(names, size) == [owner[i] for i in range(size)]


def test_placing_edge_rows(spark):
    docs = clashing(edge_docs(spark))
    got = S.place(docs, ["a", "b", "c"], 101)
    assert got.count() == 9 and set(got.columns) == set(docs.columns)
    by = {}
    for d, s in rows(got, "doc_id", "shard"):
        by.setdefault(d, set()).add(s)
    assert all(len(s) == 1 for s in by.values())
    assert "Python" not in got._jdf.queryExecution().toString()
    assert S.place(spark.createDataFrame([], DOCS), ["a"], 7).count() == 0
