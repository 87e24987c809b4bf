"""The booster over rows in batches against one that grows leaf by leaf in memory."""
import heapq
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sextant.functions.hashing import uniform
from sextant.operators import search as S

P = {"learning_rate": 0.2, "num_leaves": 7, "subsample": 1.0, "colsample": 1.0, "min_child": 20, "reg_alpha": 0.1, "reg_lambda": 1.0}


def plain(codes, y, n, p, rounds, bins=S.BINS):
    """Leaf by leaf; rows from ``n`` on are only scored."""
    score = np.full(len(codes), math.log(y[:n].mean() / (1 - y[:n].mean())))
    for _ in range(rounds):
        prob = 1 / (1 + np.exp(-score[:n]))
        g, h, w = prob - y[:n], prob * (1 - prob), np.ones(n)

        def leaf(rows):
            own = rows[rows < n]
            return S.best_split(codes[own], g[own], h[own], w[own], bins, p), rows, own
        leaves, queue, closed = [leaf(np.arange(len(codes)))], [], 0
        if leaves[0][0]:
            queue.append((-leaves[0][0][0], 0))
        while queue and len(leaves) - closed < p["num_leaves"]:
            _, i = heapq.heappop(queue)
            (_, f, b), rows, _ = leaves[i]
            goes = codes[rows, f] <= b
            leaves[i], closed = None, closed + 1
            for part in (rows[goes], rows[~goes]):
                leaves.append(leaf(part))
                if leaves[-1][0]:
                    heapq.heappush(queue, (-leaves[-1][0][0], len(leaves) - 1))
        for item in leaves:
            if item is not None:
                _, rows, own = item
                gs = g[own].sum()
                score[rows] -= p["learning_rate"] * math.copysign(max(abs(gs) - p["reg_alpha"], 0.0), gs) / (h[own].sum() + p["reg_lambda"])
    return score[n:]


@pytest.mark.parametrize("batch,in_files", [(2700, False), (400, False), (400, True)])
@pytest.mark.parametrize("leaves", [2, 7, 40])
def test_trees_are_those_grown_leaf_by_leaf(batch, in_files, leaves):
    rng = np.random.default_rng(4)
    x = rng.random((2700, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.4) ^ (rng.random(2700) < 0.1)).astype(float)
    codes = S.bin_codes(x.T, S.bin_edges(x[:2000]))
    held, p = np.arange(2700) >= 2000, P | {"num_leaves": leaves}
    parts = [(codes[:, i:i + batch], y[i:i + batch], held[i:i + batch]) for i in range(0, 2700, batch)]
    got = np.concatenate([s for _, s in S.boost_rows(lambda: parts, p, 5, np.random.default_rng(1), in_files=in_files)])
    assert np.allclose(got, plain(codes.T.astype(int), y, 2000, p, 5), atol=1e-9)


def test_a_sample_without_replacement_over_batches(monkeypatch):
    seen, sums = [], S._node_sums
    monkeypatch.setattr(S, "_node_sums", lambda c, node, m, g, *a: (seen.append(len(g)) if m == 1 else None, sums(c, node, m, g, *a))[1])
    rng = np.random.default_rng(4)
    codes, y = rng.integers(0, 32, (2, 1000)).astype(np.uint8), rng.integers(0, 2, 1000).astype(float)
    parts = [(codes[:, i:i + 300], y[i:i + 300], np.zeros(len(y[i:i + 300]), bool)) for i in range(0, 1000, 300)]
    list(S.boost_rows(lambda: parts, P | {"subsample": 0.35}, 3, np.random.default_rng(1)))
    assert len(seen) == 12 and all(sum(seen[i:i + 4]) == 350 for i in (0, 4, 8))


def test_rows_of_the_search(spark, monkeypatch):
    n = 3000                                                 # the bound was 1,000
    rows = spark.range(n).select(F.col("id").alias("_id"), (F.col("id") % 2).cast("double").alias("_y"), (F.col("id") % 3).cast("int").alias("_fold"),
                                 uniform("id", seed=1).alias("_x0"), uniform("id", seed=2).alias("_x1"))
    b = S.binned(rows, 2, 3)
    x = np.array([(r._x0, r._x1) for r in rows.orderBy("_id").collect()])
    monkeypatch.setattr(S, "BATCH_ROWS", 256)
    for f in range(3):
        parts = list(b.parts(f))
        codes, y, held = (np.concatenate([p[i] for p in parts], axis=-1) for i in range(3))
        assert max(len(p[1]) for p in parts) == 256 and len(y) == n
        assert (held == (np.arange(n) % 3 == f)).all() and (y == np.arange(n) % 2).all()
        assert (codes == S.bin_codes(x.T, S.bin_edges(x[~held]))).all()
    one = b.score(0, P, 3, np.random.default_rng(1))
    monkeypatch.setattr(S, "MEMORY_ROWS", 10)
    assert one == b.score(0, P, 3, np.random.default_rng(1))
