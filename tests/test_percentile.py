"""The distributed exact percentile equals Spark's percentile aggregate."""
import pytest
from pyspark.sql import functions as F

from sextant.operators.stats import percentile_table

PS = [0.0, 0.1, 1 / 6, 0.25, 0.5, 0.75, 0.98, 1.0]


def test_distributed_equals_percentile(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 11).alias("k"),   # hot key 0
        F.when(F.col("id") % 13 == 0, F.lit(None)).otherwise(F.round((F.col("id") * 7919) % 1000 / 7.0, 1)).alias("x"),
        (F.col("id") % 5).cast("double").alias("z"))
    got = percentile_table(df, "k", ["x", "z"], PS, n_chunks=16)
    want = df.groupBy("k").agg(*[F.percentile(c, PS).alias(f"_{c}") for c in ["x", "z"]])
    g = {r["k"]: r for r in got.collect()}
    for r in want.collect():
        for c in ["x", "z"]:
            for j in range(len(PS)):
                assert g[r["k"]][f"{c}_q{j}"] == pytest.approx(r[f"_{c}"][j], rel=1e-12, abs=1e-12)


def test_default_chunks_equal_percentile(spark):
    df = spark.range(3000).select((F.col("id") % 4).alias("k"), ((F.col("id") * 31) % 97 / 3.0).alias("x"))
    got = {r["k"]: r for r in percentile_table(df, "k", "x", PS).collect()}
    for r in df.groupBy("k").agg(F.percentile("x", PS).alias("w")).collect():
        assert [got[r["k"]][f"x_q{j}"] for j in range(len(PS))] == pytest.approx(r["w"], rel=1e-12)


def test_distributed_global_and_null_group(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 4.0), (1, 10.0), (2, None)], "k int, x double")
    g = percentile_table(df, [], "x", [0.5, 0.1]).first()
    assert percentile_table(df, [], "x", [0.5]).first()["x_q0"] == pytest.approx(3.0)
    assert g["x_q0"] == pytest.approx(3.0) and g["x_q1"] == pytest.approx(1.3)
    keyed = {r["k"]: r["x_q0"] for r in percentile_table(df, "k", "x", [0.5]).collect()}
    assert keyed == {1: 3.0}


def test_global_percentile_of_all_null_column_is_one_null_row(spark):
    from sextant.operators import impute
    df = spark.createDataFrame([(1, 1, None), (2, 1, None)], "id int, g int, x double")
    rows = percentile_table(df, [], "x", [0.5]).collect()
    assert len(rows) == 1 and rows[0]["x_q0"] is None
    out = impute.impute_median_cascade(df, "x", ["g"])
    assert out.count() == 2 and out.where("x IS NOT NULL").count() == 0


def test_null_key_is_a_group(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (None, 5.0), (None, 9.0), (None, None)], "k int, x double")
    for n_chunks in (1, 2, 64):
        got = {r["k"]: r["x_q0"] for r in percentile_table(df, "k", "x", [0.5], n_chunks=n_chunks).collect()}
        assert got == {1: 1.5, None: 7.0}


def test_result_does_not_depend_on_the_chunks(spark):
    df = spark.range(2000).select((F.col("id") % 3).alias("k"), F.pow(F.lit(1.01), F.col("id")).alias("x"))
    one = sorted(map(tuple, percentile_table(df, "k", "x", PS, n_chunks=1).collect()))
    for n in (2, 7, 300):
        assert sorted(map(tuple, percentile_table(df, "k", "x", PS, n_chunks=n).collect())) == one


def test_global_fallback_fills_above_a_million_distinct_values(spark):
    from sextant.operators import impute
    n = 1_100_000
    df = spark.range(n + 2).select("id", (F.col("id") % 50).alias("g"), F.col("id").cast("double").alias("x"))
    df = df.select("id", F.when(F.col("id") == n, 1000).when(F.col("id") < n, F.col("g")).alias("g"),
                   F.when(F.col("id") < n, F.col("x")).alias("x"))
    out = impute.impute_median_cascade(df, "x", ["g"]).where(F.col("id") >= n).select("x").collect()
    assert [r.x for r in out] == [(n - 1) / 2] * 2


def test_amounts_fall_back_to_the_global_median(spark):
    from sextant.operators import impute
    df = spark.createDataFrame([(1, False, "a", 1.0), (2, False, "a", 3.0), (3, False, None, None), (4, False, "b", None),
                                (5, True, "a", None), (6, False, "a", None)], "id int, f boolean, c string, x double")
    got = {r.id: r.x for r in impute.impute_amounts(df, ["x"], "f", "c").collect()}
    assert got == {1: 1.0, 2: 3.0, 3: 1.0, 4: 1.0, 5: 0.0, 6: 1.0}


def test_no_job_runs_while_plans_are_built(spark):
    from sextant.operators import impute
    df = spark.createDataFrame([(1, "a", "b", 1.0), (2, "a", None, None)], "id int, c string, d string, x double")
    tracker, group = spark.sparkContext.statusTracker(), "plan-only"
    spark.sparkContext.setJobGroup(group, "plans")
    try:
        impute.impute_category_cascade(df, [("c", "d")], {"d": "mode"})
        impute.impute_median_cascade(df, "x", ["c"])
        impute.impute_amounts(df.withColumn("f", F.lit(False)), ["x"], "f", "c")
        assert not tracker.getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setJobGroup("tests", "")
