"""The stream-safe operators run unchanged on a Structured Streaming source."""

import tempfile

from pyspark.sql import functions as F

from metaweave.functions import recode
from metaweave.operators import replace_sentinels, restrict_to
from tests.conftest import SF001


def _clean(df, cohort):
    out = replace_sentinels(df, ["4-NOT SPECIFIED"])
    out = out.withColumn("sample_type", recode("o_orderstatus", [("F", "BEN"), ("O", "TUM"), ("P", "MET")]))
    return restrict_to(out, cohort, "o_custkey").select("o_orderkey", "o_custkey", "o_orderpriority", "sample_type")


def test_stream_static_cohort_matches_batch(spark):
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    cohort = spark.read.parquet(f"{SF001}/customer.parquet").filter(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("id"))
    batch = sorted(map(tuple, _clean(orders, cohort).collect()), key=str)

    stream = (spark.readStream.schema(orders.schema).option("pathGlobFilter", "orders.parquet")
              .option("maxFilesPerTrigger", 1).parquet(SF001))
    query = (
        _clean(stream, cohort).writeStream.format("memory").queryName("mw_orders_stream")
        .option("checkpointLocation", tempfile.mkdtemp(prefix="mw-stream-")).outputMode("append").start()
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    got = sorted(map(tuple, spark.table("mw_orders_stream").collect()), key=str)
    assert got == batch and len(got) > 0
