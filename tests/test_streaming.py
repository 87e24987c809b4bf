"""Fitted tables applied to a file stream give the same rows as the batch apply."""
import shutil
import tempfile

from pyspark.sql import functions as F

from sextant.operators import encode
from sextant.streaming import apply_lookups, scores_to_predictions

SF = "/root/testdata/sf0.001"


def test_stream_static_target_encoding(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    base = orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("cat"),
                         (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    train = base.where("id % 3 <> 0")
    prior = train.agg(F.avg("y")).first()[0]
    table = (train.groupBy("cat").agg(F.sum("y").alias("_s"), F.count("y").alias("_n"))
                  .select("cat", ((F.col("_s") + 10 * prior) / (F.col("_n") + 10)).alias("te_cat")))
    src = tempfile.mkdtemp(prefix="sextant-src-")      # a stream source is a directory
    shutil.copy(f"{SF}/orders.parquet", f"{src}/part-0.parquet")
    stream = (spark.readStream.schema(orders.schema).parquet(src)
              .select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("cat")))
    applied = apply_lookups(stream, [(table, ["cat"], {"te_cat": prior})])
    applied = scores_to_predictions(applied, "te_cat", 0.3)
    chk = tempfile.mkdtemp(prefix="sextant-stream-")
    q = (applied.writeStream.format("memory").queryName("te_stream").outputMode("append")
         .option("checkpointLocation", chk).start())
    q.processAllAvailable()
    q.stop()
    got = {r["id"]: (round(r["te_cat"], 9), r["prediction"]) for r in spark.sql("SELECT * FROM te_stream").collect()}
    batch = encode.target_encode_full(train, base.select("id", "cat"), ["cat"], "y", 10.0, prior=prior)
    want = {r["id"]: (round(r["te_cat"], 9), int(r["te_cat"] >= 0.3)) for r in batch.collect()}
    assert got == want
