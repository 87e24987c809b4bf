import random
import re

import numpy as np
import pyarrow as pa
import pytest
from cases import DOCS, clashing, edge_docs, rows, words

from sextant.llm import jaccard as J
from sextant.llm import textkernel as K

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fold(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def grams(t, k=5):
    w = WORD.findall(fold(t))
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(docs, k=5, percent=80):
    """{row number: smallest id reachable} by comparing all pairs."""
    sets = [grams(t, k) for _, t in docs]
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(docs)):
        for j in range(i):
            x = len(sets[i] & sets[j])
            if x and 100 * x >= percent * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(docs):
        low[root(i)] = min((x for x in (low.get(root(i)), d) if x is not None), default=None)
    return [(d, len(sets[i]), low[root(i)]) for i, (d, _) in enumerate(docs)]


def near_copies(seed, n_groups=12, hub=60):
    """Groups of edited copies, exact copies, a shared passage, a hub text whose
    copies carry few to many edits (some link only through others)."""
    rng, out = random.Random(seed), []
    passage = words(rng, 30)
    for _ in range(n_groups):
        base = words(rng, rng.randrange(3, 160))
        for _ in range(rng.randrange(1, 6)):
            w = list(base)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
            out.append(w + (passage if rng.random() < 0.3 else []))
        out.append(list(base))
    base = words(rng, 120)
    for i in range(hub):
        w = list(base)
        for _ in range(i % 9):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
        out.append(w)
    rng.shuffle(out)
    return [(i * 3 + 1, " ".join(w)) for i, w in enumerate(out)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_all_pairs(spark, seed):
    docs = near_copies(seed)
    df = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in docs], DOCS)
    got = J.ngram_jaccard_join(df, fragment_grams=2000)
    assert rows(got, "doc_id", "n_shingles", "component_id") == sorted(brute(docs), key=lambda t: tuple((True, str(x)) for x in t))


def test_first_links_are_not_needed_for_the_result(spark):
    docs = near_copies(3, n_groups=6, hub=30)
    df = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in docs], DOCS)
    one = rows(J.ngram_jaccard_join(df, n_keys=1), "doc_id", "component_id")
    many = rows(J.ngram_jaccard_join(df, n_keys=12), "doc_id", "component_id")
    assert one == many


def test_edge_rows_and_clashing_columns(spark):
    got = J.ngram_jaccard_join(clashing(edge_docs(spark)))
    r = rows(got, "doc_id", "n_shingles", "component_id")
    assert len(r) == 9
    assert (1, 0, 1) in r and (2, 0, 2) in r and (3, 0, 3) in r
    assert r.count((5, 1, 5)) == 2
    assert (None, 1, None) in r and (None, 0, None) in r


def test_empty_table(spark):
    assert J.ngram_jaccard_join(spark.createDataFrame([], DOCS)).count() == 0


def test_one_per_group_keeps_every_group_and_column(spark):
    docs = near_copies(4, n_groups=8, hub=20)
    df = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in docs] + [(docs[0][0], docs[0][1], "en", "s", 0)], DOCS)
    kept = J.one_per_group(clashing(df))
    assert kept.columns == clashing(df).columns
    assert [r[0] for r in rows(kept, "doc_id")] == [str_id for str_id in sorted({c for _, _, c in brute(docs)}, key=str)]


def test_kernel_words_and_shingles():
    texts = ["A b\tC\x0bd  e F", "", None, "solo", "é É x" * 300, "a b c d e f g"]
    col = pa.array(texts, pa.string())
    for block in (8, 1 << 18):
        seen = {}
        for a, b, w in K.word_blocks(col, block):
            d, h = K.distinct_pairs(*w.shingles(5))
            for i in range(a, b):
                seen[i] = len(np.unique(h[d == i - a]))
        assert [seen[i] for i in range(len(texts))] == [len(grams(t)) for t in texts]
    x = [w for _, _, w in K.word_blocks(pa.array(["Foo bar", "foo BAR"]))][0]
    assert (x.hash[:2] == x.hash[2:]).all()


def edited(base, *places):
    w = list(base)
    for p in places:
        w[p] = f"new{p}"
    return w


def test_rows_without_an_id_link_and_bridge(spark):
    """A pair of near copies, one without an id; a bridge without an id between two
    texts that do not link themselves; a group without any id."""
    rng = random.Random(9)
    a, b, c = (words(rng, 100, 5000) for _ in range(3))
    docs = [(5, a), (None, edited(a, 3)), (10, edited(b, 3, 20)), (None, b), (11, edited(b, 60, 80)),
            (None, c), (None, edited(c, 50)), (None, c), (40, words(rng, 50, 5000)), (None, words(rng, 50, 5000))]
    docs = [(d, " ".join(t)) for d, t in docs] + [(None, None), (None, "")]
    df = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in docs], DOCS)
    got = J.ngram_jaccard_join(df, fragment_grams=200)
    want = brute(docs)
    assert {(5, 5), (10, 10), (11, 10)} <= {(d, c) for d, _, c in want}
    assert sorted(map(str, rows(got, "doc_id", "n_shingles", "component_id"))) == sorted(map(str, want))
    kept = rows(J.one_per_group(df), "doc_id", "text")
    of_c = [t for d, t in kept if d is None and t in {docs[5][1], docs[6][1]}]
    rest = sorted([docs[0], docs[2], docs[8], docs[9], docs[10], docs[11]], key=str)
    assert len(of_c) == 1 and sorted([r for r in kept if r[1] not in of_c], key=str) == rest
