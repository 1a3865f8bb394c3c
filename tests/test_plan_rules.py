"""Plan rules from the test strategy: no data through a single partition, row-count invariants."""

from pyspark.sql import functions as F

from metaweave.operators import dense_code, join_on, keep_first, pivot_wider, top_values, with_row_index
from tests.conftest import SF001


def _executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_numbering_never_uses_one_partition(spark):
    df = spark.range(0, 5000).select((F.col("id") % 97).cast("string").alias("x"), F.col("id"))
    for out in (dense_code(df, "x", "code"), with_row_index(df, ["x"], "i")):
        assert "SinglePartition" not in _executed(out)


def test_keep_first_pivot_top_values_never_use_one_partition(spark):
    df = spark.range(0, 5000).select((F.col("id") % 7).alias("k"), (F.col("id") % 3).cast("string").alias("t"),
                                     F.col("id").alias("v"))
    for out in (keep_first(df, ["k"], ["v"]),
                pivot_wider(df.groupBy("k", "t").count(), "t", "count", values=["0", "1", "2"]),
                top_values(df, ["t", "k"], k=2)):
        assert "SinglePartition" not in _executed(out)


def test_left_join_on_unique_key_keeps_rows(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "lang")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    assert join_on(docs, labels, {"doc_id": "doc_id"}, how="left").count() == docs.count()
