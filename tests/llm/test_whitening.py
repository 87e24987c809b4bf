from math import floor

import numpy as np
import pytest
from cases import clashing
from hypothesis import given, settings
from hypothesis import strategies as st

from sextant.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int"
OFFSET = 1_000_000


def plain(vectors, components=32):
    """Per row (deviation), eigenvalues and whitened columns with Python integers."""
    x = [[floor(64 * float(c)) + OFFSET for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    y = [[n * r[i] - s[i] for i in range(d)] for r in x]
    cov = np.array([[sum(r[i] * r[j] for r in y) / n**3 for j in range(d)] for i in range(d)])
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    z = np.array([[t / n for t in r] for r in y]) @ u / np.sqrt(np.abs(e) + (e == 0))
    return [sum(t * t for t in r) for r in y], e, z, np.trace(cov)


def collect(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.vec_id, {})[r.component] = r
    return out


@pytest.mark.parametrize("d,components", [(12, 32), (40, 32), (5, 2)])
def test_against_integers_on_the_driver(spark, d, components):
    rng = np.random.default_rng(d)
    v = (rng.normal(size=(300, d)) * np.linspace(3, 0.4, d)).astype(np.float32)
    v[:30] = v[0]
    df = clashing(spark.createDataFrame([(i, r.tolist(), 0) for i, r in enumerate(v)], SCHEMA).repartition(5))
    got = collect(W.whiten(df, components=components))
    dev, e, z, trace = plain(v, components)
    assert len(got) == 300 and all(sorted(r) == list(range(1, min(d, components) + 1)) for r in got.values())
    assert [got[i][1].deviation for i in range(300)] == dev
    for c in range(min(d, components)):
        col = np.array([got[i][c + 1].whitened for i in range(300)])
        assert abs(got[0][c + 1].explained - e[c] / trace) < 1e-10
        sign = np.sign(col @ z[:, c])
        assert np.allclose(sign * col, z[:, c], atol=1e-7)
    one = {r.identity_error for rows in got.values() for r in rows.values()}
    assert len(one) == 1 and one.pop() < 1e-9


def test_rows_that_leave_and_odd_tables(spark):
    nan, inf = float("nan"), float("inf")
    ok = [(0, [1.0, 0.5], 0), (0, [1.0, 0.5], 0), (None, [0.0, 2.0], 0), (3, [-1.0, 0.0], None), (9, [0.25, -7.0], 1)]
    bad = [(1, None, 0), (2, [None, 1.0], 0), (4, [nan, 1.0], 0), (5, [inf, 1.0], 0), (6, [-inf, 0.0], 0),
           (7, [], 0), (8, [1.0, 2.0, 3.0], 0)]
    rows = W.whiten(spark.createDataFrame(ok + bad, SCHEMA)).collect()
    assert sorted((r.vec_id is None, r.vec_id, r.component) for r in rows) == sorted(
        (i is None, i, c) for i, _, _ in ok for c in (1, 2))
    dev, *_ = plain([v for _, v, _ in ok])
    assert sorted({(r.vec_id is None, r.vec_id or 0, r.deviation, r.n) for r in rows}) == sorted(
        {(i is None, i or 0, t, 5) for (i, _, _), t in zip(ok, dev)})
    for none in ([], [(1, None, 0)], [(1, [], 0), (2, [], 0)], [(1, [1.0, 2.0], 0)] * 4):
        assert W.whiten(spark.createDataFrame(none, SCHEMA)).count() == 0


def test_constant_dimensions_and_large_entries(spark):
    """A constant dimension and a repeated one have no component; entries of any size
    are exact, a deviation beyond a long is NULL."""
    rng = np.random.default_rng(3)
    a = rng.integers(-50, 50, 60) / 8
    v = np.stack([a, np.full(60, 2.5), a, a], axis=1).astype(np.float32)
    v[:, 3] = 3e5 * v[:, 0]
    df = spark.createDataFrame([(i, r.tolist(), 0) for i, r in enumerate(v)], SCHEMA)
    got = collect(W.whiten(df))
    assert all(list(r) == [1] for r in got.values())
    want = [t if t < 2**63 else None for t in plain(v)[0]]
    assert [got[i][1].deviation for i in range(60)] == want and len(set(want)) > 5 and None in want
    huge = spark.createDataFrame([(i, [float(i) * 1e30, 1.0], 0) for i in range(3)], SCHEMA)
    assert {r.deviation for r in W.whiten(huge).collect()} == {None}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**20), min_size=3, max_size=3), min_size=1, max_size=150))
def test_planes_give_exact_products(rows):
    x = np.array(rows, dtype=np.int64)
    bits = np.array([int(m).bit_length() for m in x.max(0)])
    planes, dim = W.bit_planes(x, bits), np.repeat(np.arange(3), bits)
    place = np.concatenate([np.arange(b) for b in bits])
    for i in range(3):
        for j in range(3):
            total = sum(int(np.bitwise_count(planes[p] & planes[q]).sum()) << int(place[p] + place[q])
                        for p in np.flatnonzero(dim == i) for q in np.flatnonzero(dim == j))
            assert total == int((x[:, i].astype(object) * x[:, j].astype(object)).sum())
