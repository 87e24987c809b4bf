"""CSV source with a declared schema, stage tables, prediction sink."""
import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sextant.sources.tables import (read_csv, read_csv_checked, read_stage_models, replace_partitions, write_predictions,
                                    write_stage)

SCHEMA = T.StructType([
    T.StructField("PassengerId", T.StringType(), False),
    T.StructField("CryoSleep", T.BooleanType(), True),
    T.StructField("Age", T.DoubleType(), True),
    T.StructField("Transported", T.BooleanType(), True),
])


def test_read_csv_declared_schema(spark):
    d = tempfile.mkdtemp(prefix="sextant-csv-")
    with open(os.path.join(d, "train.csv"), "w") as f:
        f.write("PassengerId,CryoSleep,Age,Transported\n0001_01,True,27.0,False\n0002_01,,NaN,True\n0003_01,False,,True\n")
    df = read_csv(spark, os.path.join(d, "train.csv"), SCHEMA)
    rows = {r["PassengerId"]: r for r in df.collect()}
    assert rows["0001_01"]["CryoSleep"] is True and rows["0001_01"]["Age"] == 27.0
    assert rows["0002_01"]["CryoSleep"] is None and rows["0002_01"]["Age"] is None
    assert rows["0003_01"]["Age"] is None and rows["0003_01"]["Transported"] is True


def test_stage_tables_and_sink(spark):
    d = tempfile.mkdtemp(prefix="sextant-stage-")
    preds = spark.createDataFrame([(1, "a", 0.2), (1, "b", 0.7), (2, "a", 0.9), (2, "b", 0.4)],
                                  "id int, model string, prob double")
    back = write_stage(preds, os.path.join(d, "oof"), ["model"])
    assert back.count() == 4
    sel = read_stage_models(spark, os.path.join(d, "oof"), ["a", "b", "missing"])
    assert sorted(r[0] for r in sel.select("model").distinct().collect()) == ["a", "b"]
    try:
        read_stage_models(spark, os.path.join(d, "oof"), ["a", "missing"])
        raise AssertionError("expected at least two models to be required")
    except ValueError:
        pass
    out = os.path.join(d, "submission")
    write_predictions(sel.groupBy("id").agg((F.avg("prob") >= 0.5).alias("Transported")), out, "id", "Transported")
    got = spark.read.option("header", "true").csv(out).orderBy("id").collect()
    assert [(r["id"], r["Transported"]) for r in got] == [("1", "false"), ("2", "true")]


def test_bad_rows_are_kept_and_partitions_replaced(spark):
    d = tempfile.mkdtemp(prefix="sextant-csv-")
    with open(os.path.join(d, "x.csv"), "w") as f:
        f.write("a,b,c\n1,NaN,true\nx2,2.5,false\n3,oops,true\n,,\n4,1.0,true,more\n")
    df = read_csv_checked(spark, os.path.join(d, "x.csv"), "a bigint, b double, c boolean")
    rows = [tuple(r) for r in df.collect()]
    assert rows[0] == (1, None, True, None) and rows[3] == (None, None, None, None)
    assert [r[3] for r in rows if r[3]] == ["x2,2.5,false", "3,oops,true", "4,1.0,true,more"]
    assert rows[1][1] == 2.5 and rows[2][0] == 3
    assert df.groupBy(F.col("_bad").isNotNull().alias("x")).count().where("x").first()["count"] == 3
    path = os.path.join(d, "runs")
    first = spark.createDataFrame([(1, 0, 0.1), (2, 0, 0.2), (1, 1, 0.3), (2, 1, 0.4)], "id int, run int, prob double")
    replace_partitions(first, path, ["run"])
    out = replace_partitions(spark.createDataFrame([(2, 1, 0.9), (5, 2, 0.5)], "id int, run int, prob double"), path, ["run"])
    assert sorted(tuple(r) for r in out.select("id", "run", "prob").collect()) == [(1, 0, 0.1), (2, 0, 0.2), (2, 1, 0.9), (5, 2, 0.5)]
