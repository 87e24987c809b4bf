"""Successive halving: draws, rungs, and the booster's cuts against all cuts."""
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sextant.operators import search as S

PLAIN = {"learning_rate": 0.3, "num_leaves": 4, "subsample": 1.0, "colsample": 1.0, "min_child": 1, "reg_alpha": 0.0, "reg_lambda": 1.0}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(-3, 3), st.integers(1, 3)), min_size=2, max_size=30),
       st.integers(1, 4), st.sampled_from([0.0, 0.5]), st.sampled_from([0.1, 2.0]))
def test_best_split_is_the_best_of_all_cuts(rows, min_child, alpha, lam):
    codes = np.array([r[:2] for r in rows])
    g, h, w = (np.array([float(v) for v in col]) for col in ([r[2] for r in rows], [r[3] for r in rows], [1] * len(rows)))

    def strength(pick):
        return max(abs(g[pick].sum()) - alpha, 0) ** 2 / (h[pick].sum() + lam)
    everything = np.ones(len(rows), dtype=bool)
    gains = {(f, b): strength(codes[:, f] <= b) + strength(codes[:, f] > b) - strength(everything)
             for f in range(2) for b in range(4)
             if min((codes[:, f] <= b).sum(), (codes[:, f] > b).sum()) >= min_child}
    got = S.best_split(codes, g, h, w, 4, {"reg_alpha": alpha, "reg_lambda": lam, "min_child": min_child})
    best = max(gains.values(), default=0.0)
    if got is None:
        assert best <= 1e-9
    else:
        assert got[0] == pytest.approx(best) and got[0] == pytest.approx(gains[got[1:]])


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((600, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.4)).astype(float)
    out = S.boost(x[:400], y[:400], x[400:], PLAIN, 60, np.random.default_rng(2))
    assert ((out > 0) == y[400:]).mean() > 0.93
    one = S.boost(x[:400], y[:400], x[400:], PLAIN | {"num_leaves": 2}, 1, np.random.default_rng(2))
    assert len(np.unique(one)) == 2                                  # one tree of two leaves


def frame(spark, n=600):
    y = ((F.pmod(F.hash("id", F.lit(1)), F.lit(100)) > 50) != (F.pmod(F.hash("id", F.lit(2)), F.lit(100)) > 40)).cast("int")
    return spark.range(n).select("id", F.pmod(F.hash("id", F.lit(1)), F.lit(100)).alias("a"),
                                 F.when(F.col("id") % 50 != 0, F.pmod(F.hash("id", F.lit(2)), F.lit(100))).alias("b"),
                                 F.when(F.col("id") % 11 != 0, y).alias("y"))


def test_draws_keep_to_their_ranges_and_scales(spark):
    rows = S.draw_trials(spark, 400, S.RANGES, 7).collect()
    for name, r in S.RANGES.items():
        v = np.array([row[name] for row in rows])
        assert v.min() >= r.low and v.max() <= r.high
        assert not isinstance(r.low, int) or (v == np.floor(v)).all()
        middle = math.sqrt(r.low * r.high) if r.log else (r.low + r.high) / 2
        assert 0.4 < (v < middle).mean() < 0.6


def test_rungs_and_winner(spark):
    ranges = S.RANGES | {"n_estimators": S.Range(9, 27)}
    df = frame(spark)
    args = dict(ranges=ranges, n_trials=18, folds=3, rungs=3, eta=3, seed=5, max_fit_rows=400)
    got = {r.trial: r for r in S.halving_search(df, "id", "y", ["a", "b"], **args).collect()}
    assert sorted(got) == list(range(18))
    assert [sum(r.rung >= k for r in got.values()) for k in range(3)] == [18, 6, 2]
    for r in got.values():
        assert r.rounds == max(1, math.floor(r.n_estimators * 3.0 ** (r.rung - 2) + 0.5))
    final = [r for r in got.values() if r.rung == 2]
    winner = min(final, key=lambda r: (-round(r.accuracy, 12), r.trial))
    assert [r.trial for r in got.values() if r.best] == [winner.trial] and winner.accuracy > 0.7
    again = {r.trial: r for r in S.halving_search(df.repartition(7), "id", "y", ["a", "b"], **args).collect()}
    assert got == again


def test_parameters_are_handed_on(spark):
    one = {k: S.Range(r.low, r.low, r.log) for k, r in S.RANGES.items()}
    found = S.halving_search(frame(spark, 80), "id", "y", ["a"], ranges=one | {"n_estimators": S.Range(4, 4)}, n_trials=2, rungs=1)
    best = S.best_parameters(found)
    assert best == {k: r.low for k, r in one.items()} | {"n_estimators": 4}
    gbt = S.booster(best, ["a"], 1, "y").gbt
    assert (gbt.getMaxIter(), gbt.getMaxDepth(), gbt.getMinInstancesPerNode(), gbt.getSubsamplingRate()) == (4, 5, 10, 0.6)


def test_no_labelled_row(spark):
    with pytest.raises(ValueError):
        S.halving_search(frame(spark).limit(0), "id", "y", ["a"], n_trials=1)
