"""The fitted blend and its isotonic curves against plain versions."""
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sextant.functions.hashing import uniform
from sextant.operators import isotonic
from sextant.operators.blend import Blend, BlendModel


def plain_curve(points):
    """Value per distinct score: max over a <= i of min over b >= i of the mean of a..b."""
    xs = sorted({x for x, _ in points})
    s = np.array([sum(y for p, y in points if p == x) for x in xs], dtype=float)
    n = np.array([sum(1 for p, _ in points if p == x) for x in xs], dtype=float)
    value = [max(min(s[a:b + 1].sum() / n[a:b + 1].sum() for b in range(i, len(xs))) for a in range(i + 1))
             for i in range(len(xs))]
    return xs, value


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 1)), min_size=1, max_size=60), st.integers(1, 6))
def test_pooling_ranges_and_then_blocks_is_pooling_all(points, parts):
    xs, value = plain_curve(points)
    rows = [[x, x, sum(y for p, y in points if p == x), sum(1 for p, _ in points if p == x)] for x in xs]

    def pool(blocks):
        out = []
        for b in blocks:
            isotonic.push(out, b)
        return out
    cut = [rows[len(rows) * i // parts:len(rows) * (i + 1) // parts] for i in range(parts)]
    blocks = pool([b for c in cut for b in pool(c)])
    assert blocks == pool(rows)
    got = {x: b[2] / b[3] for b in blocks for x in xs if b[0] <= x <= b[1]}
    assert np.allclose([got[x] for x in xs], value)


@pytest.mark.parametrize("parts", [1, 40])
def test_curves_and_interpolation(spark, parts):
    rng = random.Random(parts)
    rows = [(f, round(rng.random(), 2), rng.random()) for f in (0, 1, 2) for _ in range(300)]
    rows = [(f, x, int(u < x)) for f, x, u in rows if (f, x) != (1, 0.5)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        df = spark.createDataFrame(rows, "fit int, x double, y int").groupBy("fit", "x").agg(
            F.sum("y").alias("s"), F.count("*").alias("n"))
        curves = isotonic.fit_curves(df)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    grid = [-1.0, 0.0, 0.111, 0.5, 0.505, 0.73, 1.0, 2.0]
    q = spark.createDataFrame([(x,) for x in grid] + [(None,)], "x double")
    for f in (0, 1, 2):
        xs, value = plain_curve([(x, y) for g, x, y in rows if g == f])
        got = [r[0] for r in q.select(isotonic.interpolate(F.col("x"), curves[f])).collect()]
        assert np.allclose(got[:-1], np.interp(grid, xs, value)) and got[-1] is None
    assert isotonic.fit_curves(df.where("fit > 9")) == {}


def scores(spark, n=1500):
    df = spark.range(n).select("id", (F.col("id") % 97).alias("grp"), *[uniform("id", seed=s).alias(f"u{s}") for s in range(5)])
    df = df.withColumn("y", (F.col("u0") < 0.5).cast("int"))
    for m in (1, 2, 3):
        df = df.withColumn(f"p_{m}", F.lit(0.3) + F.lit(0.25) * F.col(f"u{m}") + F.lit(0.1 * m) * F.col("y"))
    return df.withColumn("p_net", F.lit(0.6) * F.col("u4") + F.lit(0.4) * F.col("y"))


def test_saved_and_loaded_model_decides_alike(spark, tmp_path):
    df = scores(spark)
    est = Blend(inputCols=["p_1", "p_2", "p_3"], labelCol="y")
    est.write().save(str(tmp_path / "est"))
    model = Blend.load(str(tmp_path / "est")).fit(df.where("id % 3 > 0"))
    model.write().save(str(tmp_path / "m"))
    again = BlendModel.load(str(tmp_path / "m"))
    assert again.extractParamMap().values().__len__() == model.extractParamMap().values().__len__()
    te = df.where("id % 3 = 0").withColumn("locked", F.when(F.col("id") % 60 == 0, F.lit(0)))
    te = te.withColumn("p_net", F.when(F.col("id") % 99 != 3, F.col("p_net")))
    a, b = (sorted(map(tuple, m.with_columns(groupCol="grp", lockCol="locked").transform(te).select(
        "id", "blend_prob", "decision", "group_prob", "group_decision").collect())) for m in (model, again))
    assert a == b and len(a) == te.count()
    by = {r[0]: r for r in a}
    assert all(r[2] == 0 == r[4] for i, r in by.items() if i % 60 == 0)
    y = {r.id: r.y for r in te.select("id", "y").collect()}
    hit = [r[2] == y[i] for i, r in by.items() if i % 60 and r[2] is not None]
    assert sum(hit) / len(hit) > 0.9
    # the stack is the logistic fit itself: its gradient vanishes on the fitted rows
    rows = df.where("id % 3 > 0").select("y", "p_1", "p_2", "p_3").collect()
    w = np.array(model.getOrDefault(model.stack))
    x = np.array([[1.0, *r[1:]] for r in rows])
    t = np.array([r.y for r in rows])
    grad = x.T @ (1 / (1 + np.exp(-x @ w)) - t)
    grad[1:] += w[1:] / 0.5
    assert np.abs(grad).max() < 0.05 * len(rows) ** 0.5


@pytest.mark.parametrize("bend", [False, True])
def test_gate_uses_calibration_only_if_it_helps(spark, bend):
    """With the right answer above every cut of the grid only calibrated scores can be cut."""
    df = spark.range(1200).select("id", uniform("id", seed=1).alias("u"))
    edge = 0.9 if bend else 0.5
    df = df.withColumn("y", (F.col("u") > edge).cast("int"))
    for m in ("p_1", "p_2", "p_net"):
        df = df.withColumn(m, F.col("u"))
    model = Blend(inputCols=["p_1", "p_2"], labelCol="y", stack=[-2.0, 2.0, 2.0], meta=[-1.0, 1.0, 1.0]).fit(df)
    assert model.getOrDefault(model.calibrated) is bend
    acc = model.transform(df).agg(F.avg((F.col("decision") == F.col("y")).cast("double"))).first()[0]
    assert acc > 0.98


def test_rows_without_label_or_score_and_empty_tables(spark):
    df = scores(spark, 400)
    holes = df.withColumn("y", F.when(F.col("id") % 7 > 0, F.col("y"))).withColumn("p_2", F.when(F.col("id") % 11 > 0, F.col("p_2")))
    est = Blend(inputCols=["p_1", "p_2"], labelCol="y", stack=[-1.0, 1.0, 1.0], meta=[-1.0, 1.0, 1.0])
    full = est.fit(holes.dropna())
    part = est.fit(holes)
    assert full.getOrDefault(full.threshold) == part.getOrDefault(part.threshold)
    assert full.curves() == part.curves()
    out = part.transform(holes)
    assert out.count() == 400 and out.where("decision is null").count() == holes.where("p_2 is null").count()
    with pytest.raises(ValueError):
        est.fit(df.where("id < 0"))
