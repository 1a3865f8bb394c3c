"""A key holding a third of the rows must be split by AQE, never run whole in one task.

Thresholds are lowered so that the local test data counts as skewed.
"""

import pytest
from pyspark.sql import functions as F

from metaweave.operators import join_na, keep_first, restrict_to

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    n = 120_000
    # a third of the fact rows have a NULL key (NULL matches NULL), a third share key 7 in the id set
    facts = spark.range(0, n).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("k"),
                                     F.col("id").alias("v"))
    dim = spark.range(0, n).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    ids = spark.range(0, n).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("id"))
    yield facts, dim, ids, n
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _final_plan(df):
    rows = df.collect()
    return len(rows), df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how,expected", [("inner", 2 / 3), ("left", 1.0), ("full", 4 / 3)])
def test_hot_null_key_is_split(skewed, how, expected):
    facts, dim, _, n = skewed
    count, plan = _final_plan(join_na(facts, dim, ["k"], how=how))
    assert count == round(n * expected)
    assert "SortMergeJoin(skew=true)" in plan
    assert "FullOuter" not in plan  # full joins run as left outer + anti, both splittable


def test_hot_key_semi_join_is_split(skewed):
    facts, _, ids, n = skewed
    count, plan = _final_plan(restrict_to(facts, ids, "k"))
    assert count == n * 2 // 3
    assert "SortMergeJoin(skew=true)" in plan


def test_keep_first_hot_key_is_reduced_before_shuffle(skewed):
    facts, _, _, _ = skewed
    hot = facts.withColumn("g", (F.col("v") % 1000 == 0).cast("int"))  # 99.9% of rows share g = 0
    count, plan = _final_plan(keep_first(hot, ["g"], ["v"]))
    assert count == 2
    # the partial group limit runs below the exchange: each map task ships one row per key
    final_plan = plan.split("== Initial Plan ==")[0]
    _, _, below = final_plan.partition("Exchange hashpartitioning")
    assert "WindowGroupLimit" in below and "Partial" in below


def test_plain_full_outer_join_is_not_split_by_aqe(skewed):
    """Why full joins are rewritten: AQE leaves a skewed FullOuter sort-merge join whole."""
    facts, dim, _, n = skewed
    hot = facts.withColumn("k", F.coalesce(F.col("k"), F.lit(5)))  # the NULL third becomes key 5
    count, plan = _final_plan(join_na(hot, dim, ["k"], how="full", null_equal=False, skew_safe_full=False))
    assert count > n
    assert "FullOuter" in plan and "skew=true" not in plan
    count2, plan2 = _final_plan(join_na(hot, dim, ["k"], how="full", null_equal=False))
    assert count2 == count and "SortMergeJoin(skew=true)" in plan2
