import pytest
from pyspark.sql import functions as F

from metaweave.operators import dense_code, dense_codes, group_count, keep_first, pivot_wider, with_row_index
from tests.conftest import rows


@pytest.fixture
def pairs(spark):
    # red + green, red only, red twice (duplicate cell)
    return spark.createDataFrame(
        [("s1", "red", "f1r", "d1"), ("s1", "green", "f1g", "d2"), ("s2", "red", "f2r", "d3"),
         ("s3", "red", "f3a", "d4"), ("s3", "red", "f3b", "d5")],
        "sample string, idat string, file_name string, updated string")


def test_pivot_two_values_names_and_missing(pairs):
    ok = pairs.filter(F.col("sample") != "s3")
    out = pivot_wider(ok, "idat", ["file_name", "updated"], values=["green", "red"])
    assert out.columns == ["sample", "file_name_green", "file_name_red", "updated_green", "updated_red"]
    assert rows(out) == [("s1", "f1g", "f1r", "d2", "d1"), ("s2", None, "f2r", None, "d3")]


def test_pivot_duplicate_policies(pairs):
    with pytest.raises(Exception, match="more than one row"):
        pivot_wider(pairs, "idat", "file_name", values=["green", "red"], id_cols=["sample"]).collect()
    first = pivot_wider(pairs, "idat", "file_name", values=["green", "red"], id_cols=["sample"], on_duplicate="first")
    assert ("s3", None, "f3a") in rows(first)
    lst = pivot_wider(pairs, "idat", "file_name", values=["green", "red"], id_cols=["sample"], on_duplicate="list")
    got = {r.sample: r.red for r in lst.collect()}
    assert got["s3"] == ["f3a", "f3b"]


def test_pivot_fill_and_resum_invariant(spark):
    df = spark.createDataFrame([(1, "TUM"), (1, "TUM"), (1, "BEN"), (2, "MET"), (3, None)], "d int, t string")
    counts = group_count(df.filter(F.col("t").isNotNull()), ["d", "t"])
    wide = pivot_wider(counts, "t", "n", values=["BEN", "MET", "TUM"], fill=0)
    assert rows(wide) == [(1, 1, 0, 2), (2, 0, 1, 0)]
    total = wide.select(F.sum(F.col("BEN") + F.col("MET") + F.col("TUM"))).first()[0]
    assert total == df.filter(F.col("t").isNotNull()).count()


def test_pivot_null_key_column(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, None, 2), (2, "a", 3)], "d int, k string, v int")
    out = pivot_wider(df, "k", "v", values=["a", None])
    assert out.columns == ["d", "a", "NA"]
    assert rows(out) == [(1, 1, 2), (2, 3, None)]


def test_pivot_values_discovered(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 2)], "d int, k string, v int")
    assert pivot_wider(df, "k", "v").columns == ["d", "a", "b"]


def test_keep_first_total_order_and_partition_independence(spark):
    data = [(1, 5, "x"), (1, 5, "a"), (1, 7, "b"), (2, 1, "c"), (None, 1, "n1"), (None, 0, "n2")]
    df = spark.createDataFrame(data, "k int, o int, v string")
    expect = [(None, 0, "n2"), (1, 5, "a"), (2, 1, "c")]
    assert rows(keep_first(df, ["k"], ["o"])) == expect
    shuffled = spark.createDataFrame(list(reversed(data)), df.schema).repartition(5)
    assert rows(keep_first(shuffled, ["k"], ["o"])) == expect


def test_keep_first_plan_has_partial_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"))
    plan = keep_first(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_dense_code_bijection_nulls_and_numeric_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("c",)], "x string")
    out = dense_code(df, "x", "code")
    assert rows(out) == [(None, None), ("a", "NEW_1"), ("b", "NEW_2"), ("b", "NEW_2"), ("c", "NEW_3")]
    nums = spark.createDataFrame([(10,), (9,), (100,)], "n int")
    got = {r.n: r.n_code for r in dense_codes(nums, ["n"]).collect()}
    assert got == {9: 1, 10: 2, 100: 3}


def test_dense_codes_several_columns(spark):
    df = spark.createDataFrame([("b", "y"), ("a", "z"), ("a", "y")], "p string, q string")
    out = dense_codes(df, ["p", "q"])
    assert rows(out) == [("a", "y", 1, 1), ("a", "z", 1, 2), ("b", "y", 2, 1)]


def test_with_row_index_is_1_to_n_and_repeatable(spark):
    df = spark.range(0, 1000).select((F.col("id") % 7).alias("g"), F.col("id"))
    a = with_row_index(df, ["g"], "i")
    assert a.agg(F.min("i"), F.max("i"), F.count_distinct("i")).first() == (1, 1000, 1000)
    b = with_row_index(df.repartition(3), ["g"], "i")
    assert rows(a) == rows(b)
    first = a.filter(F.col("i") == 1).first()
    assert (first.g, first.id) == (0, 0)


def test_numbering_avoids_single_partition_window(spark):
    df = spark.range(0, 100).select(F.col("id").cast("string").alias("x"))
    plan = dense_code(df, "x", "code")._jdf.queryExecution().executedPlan().toString()
    # the only window is over the per-partition count table; data never goes through one task
    assert "BatchEvalPython" not in plan and "CartesianProduct" not in plan


def test_pivot_keeps_real_rows_nulls_and_names(spark):
    df = spark.createDataFrame(
        [(1, "i", "b.idat", 2020), (1, "i", "a.idat", 2021), (2, "i", None, 2022), (2, "i", "c", None), (3, None, "d", 1)],
        "s int, k string, f string, y int")
    first = pivot_wider(df, "k", ["f", "y"], id_cols=["s"], on_duplicate="first")
    assert first.columns == ["s", "f_i", "f_NA", "y_i", "y_NA"]
    assert rows(first) == [(1, "a.idat", None, 2021, None), (2, "c", None, None, None), (3, None, "d", None, 1)]
    lists = pivot_wider(df, "k", "f", values=["i", None], id_cols=["s"], on_duplicate="list")
    assert {r.s: (r.i, r.NA) for r in lists.collect()} == {1: (["a.idat", "b.idat"], None), 2: ([None, "c"], None), 3: (None, ["d"])}


def test_pivot_fills_absent_cells_only(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", 5), (2, "a", 3)], "d int, k string, v int")
    assert rows(pivot_wider(df, "k", "v", values=["a", "b"], fill=0)) == [(1, None, 5), (2, 3, 0)]


def test_pivot_raises_for_names_that_are_not_listed(spark):
    df = spark.createDataFrame([(1, "a", 1), (3, "z", 9), (1, None, 6)], "d int, k string, v int")
    for listed in (["a"], ["a", "z"]):
        with pytest.raises(Exception, match="is not listed"):
            pivot_wider(df, "k", "v", values=listed).collect()
    assert rows(pivot_wider(df, "k", "v", values=["a"], unlisted="drop")) == [(1, 1), (3, None)]
    with pytest.raises(ValueError, match="more than 1 distinct"):
        pivot_wider(df, "k", "v", max_names=1)


def test_dense_codes_of_mixed_types(spark):
    df = spark.createDataFrame(
        [("b", "y", 10, "p", 1.5), ("a", None, 9, "q", 1.5), ("a", "y", 100, None, 0.5), ("c", "x", None, "p", 2.5)],
        "s1 string, s2 string, n int, s3 string, d double")
    cols = ["s1", "s2", "n", "s3", "d"]
    wide = dense_codes(df, cols, prefix="K")
    assert wide.columns == cols + [f"{x}_code" for x in cols]
    got = {(r.s1, r.n): (r.s1_code, r.n_code, r.s2_code) for r in wide.collect()}
    assert got[("a", 100)] == ("K1", "K3", "K2") and got[("c", None)] == ("K3", None, "K1")
