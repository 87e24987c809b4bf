"""Membership looks at every group of the training rows."""
import datetime

from sextant.plans import orders_queries


def test_semi_join_coverage_knows_every_training_group(spark, tmp_path):
    day = datetime.datetime(1995, 1, 1)
    # keys divisible by 3 are test rows; group 13 has a training row, group 7 has none
    rows = [(1, 13, "F", 1.0, day, "1-URGENT"), (3, 13, "O", 2.0, day, "1-URGENT"), (6, 7, "F", 3.0, day, "2-HIGH")]
    spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                                "o_orderdate timestamp, o_orderpriority string").write.parquet(str(tmp_path / "orders.parquet"))
    out = orders_queries.semi_join_coverage(spark, str(tmp_path)).collect()
    assert {r["id"]: r["in_train"] for r in out} == {3: 1, 6: 0}
