"""Edge fixtures for column builders (FIXTURES.md section 3)."""
import math

import pytest
from pyspark.sql import functions as F

from sextant.functions import columns as C


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy("i").collect()]


def test_surname_extract(spark):
    df = spark.createDataFrame([(0, "Solo"), (1, "A B C"), (2, None)], "i int, name string")
    assert rows(df.select("i", C.surname_extract("name").alias("s")), "s") == [("Unknown",), ("B C",), ("Unknown",)]


def test_parse_delimited_field(spark):
    df = spark.createDataFrame([(0, None), (1, "F/12/S"), (2, "F/x/S")], "i int, cabin string")
    d, n, s = C.parse_delimited_field("cabin")
    out = rows(df.select("i", d.alias("d"), n.alias("n"), s.alias("s")), "d", "n", "s")
    assert out == [("U", 9999.0, "U"), ("F", 12.0, "S"), ("F", None, "S")]


def test_split_composite_key(spark):
    df = spark.createDataFrame([(0, "0004_02"), (1, "x_1"), (2, None)], "i int, k string")
    g, m = C.split_composite_key("k")
    assert rows(df.select("i", g.alias("g"), m.alias("m")), "g", "m") == [(4, 2), (None, 1), (None, None)]


def test_infer_flag_from_amounts(spark):
    df = spark.createDataFrame([(0, None, 0.0), (1, None, 5.0), (2, True, 5.0)], "i int, f boolean, a double")
    out = rows(df.select("i", C.infer_flag_from_amounts("f", ["a"]).alias("f")), "f")
    assert out == [(True,), (False,), (True,)]


def test_argmax_category(spark):
    df = spark.createDataFrame([(0, 0.0, 0.0), (1, 1.0, 1.0), (2, 1.0, 2.0)], "i int, a double, b double")
    out = rows(df.select("i", C.argmax_name(["a", "b"], ["first", "second"]).alias("m")), "m")
    assert out == [("first",), ("first",), ("second",)]


def test_spend_entropy(spark):
    df = spark.createDataFrame([(0, [0.0] * 5), (1, [10.0, 0.0, 0.0, 0.0, 0.0]), (2, [1.0] * 5)], "i int, a array<double>")
    df = df.select("i", *[F.col("a")[j].alias(f"c{j}") for j in range(5)])
    out = [r[0] for r in rows(df.select("i", C.row_entropy([f"c{j}" for j in range(5)]).alias("e")), "e")]
    assert out[0] == pytest.approx(1.03616e-7, rel=1e-4)
    assert out[1] == pytest.approx(8.28931e-8, rel=1e-4)
    assert out[2] == pytest.approx(math.log(5), rel=1e-9)


def test_range_flags(spark):
    ages = [None, 12.5, 13.0, 17.9, 18.0, 60.0]
    df = spark.createDataFrame(list(enumerate(ages)), "i int, age double")
    a = F.col("age")
    out = rows(df.select("i", C.flag(a < 13).alias("c"), C.flag((a >= 13) & (a < 18)).alias("t"),
                         C.flag(a >= 60).alias("s")), "c", "t", "s")
    assert [r[0] for r in out] == [0, 1, 0, 0, 0, 0]
    assert [r[1] for r in out] == [0, 0, 1, 1, 0, 0]
    assert [r[2] for r in out] == [0, 0, 0, 0, 0, 1]


def test_age_band(spark):
    ages = [0, 12, 12.5, 13, 18, 60, 121, None]
    df = spark.createDataFrame([(i, None if a is None else float(a)) for i, a in enumerate(ages)], "i int, age double")
    out = [r[0] for r in rows(df.select("i", C.right_closed_band("age", C.AGE_BAND_EDGES, C.AGE_BAND_LABELS)
                                        .alias("b")), "b")]
    assert out == ["child", "child", "teen", "teen", "teen", "midlife", "nan", "nan"]


def test_eda_band_edges(spark):
    labels = ["b0", "b1", "b2", "b3", "b4", "b5"]
    df = spark.createDataFrame([(0, 0.0), (1, 13.0), (2, 12.5)], "i int, age double")
    out = [r[0] for r in rows(df.select("i", C.right_closed_band("age", C.EDA_AGE_EDGES, labels, "outside")
                                        .alias("b")), "b")]
    assert out == ["outside", "b0", "b0"]


def test_equal_width_code(spark):
    vals = [0.0, 5.0, 1000.0, 1001.0, 1894.0, 9999.0, None]
    df = spark.createDataFrame(list(enumerate(vals)), "i int, x double")
    r = df.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    out = df.crossJoin(r).select("i", C.equal_width_code("x", F.col("lo"), F.col("hi"), 10).alias("b"))
    assert [x[0] for x in rows(out, "b")] == [0, 0, 1, 1, 1, 9, -1]


def test_quantile_bucket(spark):
    vals = [0.0, 1, 2, 3, 4, 5, 6, 9999, 9999, 9999, 9999]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "i int, x double")
    e = df.agg(F.array_distinct(F.percentile("x", [k / 6 for k in range(7)])).alias("edges"))
    edges = e.first()["edges"]
    assert [round(x, 4) for x in edges] == [0.0, 1.6667, 3.3333, 5.0, 6668.0, 9999.0]
    out = df.crossJoin(e).select("i", C.rank_in_edges("x", F.col("edges")).alias("b"))
    assert [x[0] for x in rows(out, "b")] == [0, 0, 1, 1, 2, 2, 3, 4, 4, 4, 4]


def test_category_cross_and_bool_text(spark):
    df = spark.createDataFrame([(0, "a", None, True), (1, None, "b", None)], "i int, x string, y string, f boolean")
    out = rows(df.select("i", C.category_cross("x", "y").alias("c"), C.bool_text("f").alias("t")), "c", "t")
    assert out == [("a_nan", "True"), ("nan_b", "False")]


def test_parity_and_slugify(spark):
    df = spark.createDataFrame([(0, 3, "  Hello, World!  "), (1, None, "***")], "i int, n int, t string")
    out = rows(df.select("i", C.parity("n").alias("p"), C.slugify("t", "table").alias("s")), "p", "s")
    assert out == [(1, "hello_world"), (-1, "table")]


def test_nan_to_null(spark):
    from sextant.sources.tables import nan_to_null
    df = spark.createDataFrame([(0, float("nan")), (1, 2.0)], "i int, x double")
    assert [r[0] for r in rows(nan_to_null(df), "x")] == [None, 2.0]
