"""The registered cross-fits fit on all rows outside a fold, however many there are."""
import pytest
from pyspark.ml import Model
from pyspark.sql import functions as F

from sextant.operators import crossfit, search
from sextant.plans import queries

SF = "/root/testdata/sf0.1"


class Half(Model):
    def _transform(self, df):
        return df.withColumn("prob", F.lit(0.5))


@pytest.mark.parametrize("name", ["category_booster_oof", "mixup_oof", "perceptron_oof", "extra_trees_oof", "searched_booster_oof"])
def test_a_fit_sees_all_rows_outside_its_fold(spark, monkeypatch, name):
    seen, cross_fit = [], crossfit.cross_fit

    def training(*args, **kw):
        def fit(rows, seed):
            seen.append(rows.count())
            return Half()
        return fit
    monkeypatch.setattr(crossfit, "training", training)
    monkeypatch.setattr(search, "halving_search", lambda *a, **kw: None)
    monkeypatch.setattr(search, "best_parameters", lambda found: {})
    monkeypatch.setattr(crossfit, "cross_fit", lambda *a, **kw: cross_fit(*a, **kw | {"seeds": [1], "folds": 2}))
    out = queries()[name](spark, SF)
    n = spark.read.parquet(f"{SF}/orders.parquet").where("o_orderkey % 3 <> 0").count()
    assert n > 2 * 20_000 and sum(seen) == n and max(seen) - min(seen) <= 2
    assert out.where("kind = 'oof'").count() == n


def test_the_search_before_the_fits_takes_all_rows(spark, monkeypatch):
    class Seen(Exception):
        pass

    def binned(rows, d, folds):
        raise Seen(rows.count())
    monkeypatch.setattr(search, "binned", binned)
    with pytest.raises(Seen) as found:
        queries()["searched_booster_oof"](spark, SF)
    assert found.value.args[0] == spark.read.parquet(f"{SF}/orders.parquet").where("o_orderkey % 3 <> 0").count()


def test_tasks_of_a_fit_follow_its_rows(spark, monkeypatch):
    monkeypatch.setattr(crossfit, "FIT_ROWS_PER_TASK", 100)
    parts, cores = [], spark.sparkContext.defaultParallelism

    class Spy(crossfit.Estimator):
        def _fit(self, df):
            parts.append(df.rdd.getNumPartitions())
            return Half()
    fit = crossfit.training(lambda s: Spy(), "id", "y", ["x"])
    rows = spark.range(5000).select("id", (F.col("id") % 2).cast("int").alias("y"), F.col("id").cast("double").alias("x"))
    for n in (90, 300, 5000):
        fit(rows.where(F.col("id") < n), 1)
    assert parts == [2, min(3, cores), cores]
