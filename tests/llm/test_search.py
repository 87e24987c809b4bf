import numpy as np
import pytest
from cases import clashing, rows

from sextant.llm import vptree as V

SCHEMA = "vec_id long, embedding array<float>, label int"


def data(n, d, seed, copies=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).astype(np.float32) * rng.uniform(0.5, 2, size=(n, 1)).astype(np.float32)
    x[:copies] = x[0]
    return x


def brute(x, k):
    s = x.astype(np.float64)
    out = []
    for q in range(0, len(x), 20):
        sc = [(-float(np.cumsum(s[q] * s[j])[-1]), j) for j in range(len(x)) if j != q]
        out += [(q, r + 1, j, round(-v, 9)) for r, (v, j) in enumerate(sorted(sc)[:k])]
    return sorted(out)


@pytest.mark.parametrize("copies", [0, 150])
def test_factor_one_is_exact(spark, copies):
    x = data(420, 8, 3, copies)
    e = clashing(spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA))
    got = V.nearest(e, e.where("vec_id % 20 = 0"), k=7, shard_rows=100, block_rows=10)
    assert sorted((a, b, c, round(d, 9)) for a, b, c, d in rows(got, "query_id", "rank", "vec_id", "score")) == brute(x, 7)


@pytest.mark.parametrize("norm", [1e-6, 1.0, 1e6, 1e9])
def test_factor_one_is_exact_at_any_norm_with_copies(norm):
    rng = np.random.default_rng(8)
    x = norm * rng.normal(size=(3000, 24))
    x[1::3] = x[0::3]                                       # copies, and close neighbours
    x[2::9] = x[0::9] * (1 + 1e-9 * rng.normal(size=x[2::9].shape))
    ids, at = rng.permutation(3000), np.arange(0, 3000, 20)
    qi, ri, score = V.search(ids[at], x[at], ids, x, 20, 1.0, np.linalg.norm(x, axis=1).max() * (1 + 1e-12), leaf=64)
    for i, a in enumerate(at):
        real = V._exact(np.repeat(x[a:a + 1], 3000, axis=0), x)
        want = [j for j in np.lexsort((ids, -real)) if j != a][:20]
        assert ri[qi == i].tolist() == want and score[qi == i].tolist() == real[want].tolist()


def test_relaxed_factor_keeps_recall():
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(20, 16))
    x = centre[rng.integers(0, 20, 4000)] + 0.15 * rng.normal(size=(4000, 16))
    ids, q = np.arange(4000), np.arange(0, 4000, 20)
    top = np.linalg.norm(x, axis=1).max()
    want = V.search(q, x[q], ids, x, 20, 1.0, top)
    got = V.search(q, x[q], ids, x, 20, 1.6, top)
    a, b = set(zip(want[0], want[1])), set(zip(got[0], got[1]))
    assert len(a & b) / len(a) >= 0.9


def test_unfit_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    e = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [None, 1.0], 0),
                               (5, [nan, 1.0], 0), (6, [inf, 1.0], 0), (None, [1.0, 1.0], 0), (7, [1.0, 1.0], None),
                               (8, [1.0, 1.0], 0), (8, [1.0, 1.0], 0), (9, [1.0, 1.0, 1.0], 0), (20, [0.0, 2.0], 0),
                               (20, [0.0, 2.0], 0)], SCHEMA)
    got = rows(V.nearest(e, e.where("vec_id % 20 = 0"), k=20), "query_id", "rank", "vec_id", "score")
    assert sorted(got) == [(0, 1, 7, 1.0), (0, 2, 8, 1.0), (0, 3, 20, 0.0), (20, 1, 7, 2.0), (20, 2, 8, 2.0), (20, 3, 0, 0.0)]
    none = spark.createDataFrame([], SCHEMA)
    assert V.nearest(none, none).count() == 0
    assert V.nearest(e, none).count() == 0
