from pyspark.sql import functions as F

from metaweave.operators import (
    annotate_match, attach_registry, count_all_null_rows, drop_replicates, find_replicates, histogram, n_unique, profile,
    reconcile, top_values,
)
from tests.conftest import rows


def test_annotate_match_levels(spark):
    # match_levels: same sample, same donor only, neither
    df = spark.createDataFrame([("D1", "D1-01A"), ("D1", "D1-11A"), ("D2", "D2-01A"), (None, None)],
                               "donor string, sample string")
    rna = spark.createDataFrame([("D1", "D1-01B")], "rna_donor string, rna_sample string")
    out = annotate_match(df, rna, "annot", exact=("sample", "rna_sample"), coarse=("donor", "rna_donor"),
                         exact_derive=lambda c: F.regexp_replace(c, ".$", ""))
    assert rows(out) == [(None, None, None), ("D1", "D1-01A", "MATCHED"), ("D1", "D1-11A", "DISTANT"),
                         ("D2", "D2-01A", None)]


def test_attach_registry_partial(spark):
    # registry_partial: found, not found, found twice
    df = spark.createDataFrame([("c1", "NEW_1"), ("c2", "NEW_2"), ("c3", "NEW_3")], "case string, donor_id string")
    reg = spark.createDataFrame([("c1", "PP_1"), ("c3", "PP_3b"), ("c3", "PP_3a")], "case string, Donor_ID string")
    out = attach_registry(df, reg, on=("case", "case"), replace={"donor_id": "Donor_ID"}, dedupe_order=["Donor_ID"])
    assert rows(out, "case", "donor_id") == [("c1", "PP_1"), ("c2", "NEW_2"), ("c3", "PP_3a")]
    pre = attach_registry(df, reg, on=("case", "case"), prefix="reg_", replace={"donor_id": "Donor_ID"},
                          dedupe_order=["Donor_ID"])
    assert pre.columns == ["case", "donor_id", "reg_Donor_ID"]


def test_replicates(spark):
    # replicates: one sample with vials A and B, one with A only, one with B only (must stay)
    df = spark.createDataFrame([("S1-01A",), ("S1-01B",), ("S2-01A",), ("S3-01B",)], "sample string")
    key = F.regexp_replace("sample", ".$", "")
    reps = find_replicates(df, key)
    assert rows(reps) == [("S1-01", 2)]
    kept = drop_replicates(df, key, rule="suffix", pattern="B$", column="sample")
    assert rows(kept) == [("S1-01A",), ("S2-01A",), ("S3-01B",)]
    first = drop_replicates(df, key, rule="first", order_by=["sample"])
    assert rows(first) == [("S1-01A",), ("S2-01A",), ("S3-01B",)]
    excl = spark.createDataFrame([("S2-01A",)], "id string")
    assert drop_replicates(df, key, rule="exclude", exclude=excl, column="sample").count() == 3


def test_counts_with_nulls(spark):
    df = spark.createDataFrame([("a", None), (None, None), ("a", "x"), ("b", None)], "p string, q string")
    assert n_unique(df, "p").first()[0] == 3  # NULL counts as one value
    assert count_all_null_rows(df).first()[0] == 1


def test_profile_and_top_values(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "a"), (3.0, None), (None, "b")], "x double, s string")
    prof = {(r.column, r.metric): r.value for r in profile(df).collect()}
    assert prof[("x", "n_missing")] == 1 and prof[("s", "n_unique")] == 2
    assert prof[("x", "mean")] == 2.0 and prof[("x", "p0")] == 1.0 and prof[("x", "p100")] == 3.0
    assert prof[("x", "p50")] == 2.0 and abs(prof[("s", "complete_rate")] - 0.75) < 1e-12
    approx = {(r.column, r.metric): r.value for r in profile(df, exact=False).collect()}
    assert approx[("s", "n_unique_approx")] == 2 and approx[("x", "mean")] == 2.0 and ("x", "p50") not in approx
    top = top_values(df, ["s"], k=1).collect()
    assert [(r.column, r.value, r.n, r.rank) for r in top] == [("s", "a", 2, 1)]


def test_profile_of_an_empty_table(spark):
    df = spark.createDataFrame([], "x double, s string")
    prof = {(r.column, r.metric): r.value for r in profile(df).collect()}
    assert prof[("x", "n_missing")] == prof[("s", "n_unique")] == 0
    assert prof[("x", "complete_rate")] is None and prof[("x", "p50")] is None and prof[("x", "mean")] is None
    assert n_unique(df, "s").first()[0] == 0


def test_quantiles_are_exact_at_any_size(spark):
    """More rows than any former sketch size; skewed and repeated values."""
    df = spark.range(1_500_000).select(F.when(F.col("id") < 500_000, F.lit(7)).otherwise((F.col("id") * 7919) % 1_000_003).alias("x"))
    prof = {r.metric: r.value for r in profile(df).collect()}
    import numpy as np

    i = np.arange(1_500_000)
    x = np.sort(np.where(i < 500_000, 7, i * 7919 % 1_000_003))
    assert [prof["p25"], prof["p50"], prof["p75"]] == [float(x[int(np.ceil(q * len(x))) - 1]) for q in (0.25, 0.5, 0.75)]


def test_histogram(spark):
    df = spark.createDataFrame([(0.0, 5.0), (1.0, 5.0), (7.9, None), (8.0, 5.0)], "x double, y double")
    got = rows(histogram(df, ["x", "y"], bins=4))
    assert got == [("x", 1, 2), ("x", 2, 0), ("x", 3, 0), ("x", 4, 2), ("y", 1, 3), ("y", 2, 0), ("y", 3, 0), ("y", 4, 0)]
    assert rows(histogram(df.limit(0), ["x"])) == []


def test_reconcile(spark):
    df = spark.createDataFrame([("TUM",), ("BEN",), ("TUM",)], "t string")
    out = reconcile(df, [("parts", F.count(F.lit(1)), F.count_if(F.col("t") == "TUM") + F.count_if(F.col("t") == "BEN")),
                         ("bad", F.lit(5), F.count(F.lit(1)))])
    assert rows(out) == [("bad", 5, 3, False), ("parts", 3, 3, True)]
