"""Key levels, checked templates, published sets, stored codes, mergeable profiles, input order."""

import random

import pytest
from pyspark.sql import functions as F

from metaweave.operators import (
    TemplateField, annotate_levels, check_template, first_appearance, merge_profiles, pivot_wider, profile, profile_parts, stable_sort_index,
    with_position,
)
from metaweave.operators.codebook import code_table, encode, extend_codes
from metaweave.sources import Check, CheckFailed, publish, published
from tests.conftest import SF001, rows


# ---------------------------------------------------------------- key levels

def test_levels_against_brute_force(spark):
    rng = random.Random(5)
    made = [tuple(rng.choice([None, *"abcdefgh"[:k]]) for k in (8, 5, 3, 2)) for _ in range(300)]
    left, right = made[:260], [r for r in made[260:] if r[3] != "b"]
    kind = "p string, q string, r string, s string"
    names = ["p", "q", "r", "s"]
    keys = [names[: 4 - i] for i in range(4)]  # all four, the first three, ... agree
    levels = [(f"L{i}", F.concat_ws("|", *[x if x in k else F.lit("") for x in names]), F.concat_ws("|", *[x if x in k else F.lit("") for x in names]))
              for i, k in enumerate(keys)]
    out = annotate_levels(spark.createDataFrame(left, kind), spark.createDataFrame(right, kind), "level", levels)

    def key(row, k):
        return "|".join((row[names.index(x)] or "\0") if x in k else "" for x in names).replace("\0|", "").replace("|\0", "").replace("\0", "")

    held = [{key(r, k) for r in right} for k in keys]
    want = [(*r, next((f"L{i}" for i, k in enumerate(keys) if key(r, k) in held[i]), None)) for r in left]
    order = lambda r: tuple((v is not None, v) for v in r)
    assert rows(out) == sorted(want, key=order)


def test_levels_null_keys_repeats_and_empty_tables(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), (None, None)], "k string, n int")
    other = spark.createDataFrame([("a", 9), (None, 2), (None, None)], "k string, n int")
    levels = [("fine", "k", "k"), ("coarse", "n", "n")]
    assert rows(annotate_levels(df, other, "m", levels)) == [(None, None, None), (None, 2, "coarse"), ("a", 1, "fine"), ("a", 1, "fine")]
    assert rows(annotate_levels(df, other.limit(0), "m", levels), "m") == [(None,)] * 4
    assert rows(annotate_levels(df.limit(0), other, "m", levels)) == []
    with pytest.raises(ValueError):
        annotate_levels(df, other, "n", levels)


def test_levels_have_two_joins_at_any_number(spark):
    df = spark.range(50).select(*[(F.col("id") % (2 + i)).alias(f"k{i}") for i in range(6)])
    for n in (1, 4, 6):
        plan = annotate_levels(df, df, "m", [(f"L{i}", f"k{i}", f"k{i}") for i in range(n)])._jdf.queryExecution().optimizedPlan().toString()
        assert sum(line.lstrip(" :+-").startswith("Join ") for line in plan.splitlines()) == 2


# ---------------------------------------------------------------- templates

FIELDS = [
    TemplateField("id", "bigint", required=True), TemplateField("kind", allowed=("x", "y")), TemplateField("code", pattern="[A-Z]{2}[0-9]+"),
    TemplateField("size", "int"), TemplateField("absent", "double"),
]


def test_template_splits_rows_and_names_every_broken_rule(spark):
    data = [("1", "x", "AB12", 3.0, "e1"), ("z", "q", "AB", 2.5, "e2"), (None, None, None, None, "e3"), ("4", "y", "AB1\n", 4.0, "e4"), ("1", "x", "AB12", 3.0, "e1")]
    df = spark.createDataFrame(data, "id string, kind string, code string, size double, extra string")
    good, rejected, problems = check_template(df, FIELDS, key=["extra"])
    assert good.dtypes == [("id", "bigint"), ("kind", "string"), ("code", "string"), ("size", "int"), ("absent", "double")]
    assert rows(good) == [(1, "x", "AB12", 3, None)] * 2
    assert rejected.columns == df.columns and rows(rejected, "extra") == [("e2",), ("e3",), ("e4",)]
    assert rows(problems) == [
        ("e2", "code", "AB", "pattern"), ("e2", "id", "z", "type"), ("e2", "kind", "q", "allowed"), ("e2", "size", "2.5", "type"),
        ("e3", "id", None, "required"), ("e4", "code", "AB1\n", "pattern"),
    ]


def test_template_of_empty_tables_missing_required_and_clashing_names(spark):
    empty = spark.createDataFrame([], "problems string, c0 string, id string")
    good, rejected, problems = check_template(empty, FIELDS, key=["problems"])
    assert rows(good) == rows(rejected) == rows(problems) == []
    df = spark.createDataFrame([("p", "q", "7")], "problems string, c0 string, id string")
    good, rejected, problems = check_template(df, [TemplateField("id", "int"), TemplateField("need", required=True)], key=["problems", "c0"])
    assert rows(good) == [] and rows(rejected) == [("p", "q", "7")] and rows(problems) == [("p", "q", "need", None, "required")]
    assert rows(check_template(df, [TemplateField("c0"), TemplateField("id", "int")], key=["id"]).conforming) == [("q", 7)]
    with pytest.raises(ValueError):
        check_template(df.withColumnRenamed("c0", "rule"), FIELDS, key=["rule"])


# ---------------------------------------------------------------- published sets

def test_publish_is_all_or_nothing(spark, tmpdir_path):
    place = f"{tmpdir_path}/set"
    a, b = spark.range(10).toDF("a"), spark.range(3).toDF("b")
    total = [Check("all even or odd", F.count(F.lit(1)), F.count_if(F.col("a") % 2 == 0) + F.count_if(F.col("a") % 2 == 1))]
    assert published.latest_version(spark, place) == 0
    with pytest.raises(KeyError):
        published.read_published(spark, place, "a")
    assert publish({"a": a, "b": b}, place, {"a": total}) == 1
    with pytest.raises(CheckFailed, match="a: short expected 10, found 9"):
        publish({"a": a, "b": b}, place, {"a": [Check("short", F.count(F.lit(1)), F.count_if(F.col("a") > 0))]})
    broken = b.select(F.when(F.col("b") < 2, F.col("b")).otherwise(F.raise_error(F.lit("lost"))).alias("b"))
    with pytest.raises(Exception, match="lost"):
        publish({"a": a.limit(1), "b": broken}, place)  # the first table is written, the second fails
    assert published.latest_version(spark, place) == 1
    assert published.read_published(spark, place, "a").count() == 10 and published.read_published(spark, place, "b").count() == 3
    # made from the set it replaces
    assert publish({"a": published.read_published(spark, place, "a").where("a < 4"), "b": b.limit(0)}, place, {"a": total}) == 2
    assert published.read_published(spark, place, "a").count() == 4 and published.read_published(spark, place, "b").count() == 0
    assert published.read_published(spark, place, "a", version=1).count() == 10
    assert rows(published.manifest(spark, place), "version", "name", "rows") == [(1, "a", 10), (1, "b", 3), (2, "a", 4), (2, "b", 0)]


def test_publish_counts_nothing_twice_behind_a_shuffle(spark, tmpdir_path):
    df = spark.range(1000).select((F.col("id") % 7).alias("k")).groupBy("k").count().repartition(5)
    publish({"t": df}, tmpdir_path, {"t": [Check("rows", F.lit(1000), F.sum("count"))]})
    assert rows(published.manifest(spark, tmpdir_path), "rows") == [(7,)]


# ---------------------------------------------------------------- stored codes

def test_codes_stay_and_repeated_loads_change_nothing(spark, tmpdir_path):
    load = lambda *values: spark.createDataFrame([(v,) for v in values], "v string")
    assert code_table(spark, tmpdir_path) is None
    assert rows(encode(load("m"), "v", tmpdir_path, "code")) == [("m", None)]
    assert extend_codes(load("m", "c", None, "m"), "v", tmpdir_path) == 2
    assert extend_codes(load("z", "a", "c"), "v", tmpdir_path) == 2
    first = rows(code_table(spark, tmpdir_path))
    assert first == [("a", 3), ("c", 1), ("m", 2), ("z", 4)]
    assert extend_codes(load("z", "a", "c"), "v", tmpdir_path) == 0 and extend_codes(load(None), "v", tmpdir_path) == 0
    assert extend_codes(load().limit(0), "v", tmpdir_path) == 0 and rows(code_table(spark, tmpdir_path)) == first
    # a load that fails leaves the dictionary as it was
    bad = load("k", "q").select(F.when(F.col("v") == "k", F.col("v")).otherwise(F.raise_error(F.lit("lost"))).alias("v"))
    with pytest.raises(Exception, match="lost"):
        extend_codes(bad, "v", tmpdir_path)
    assert rows(code_table(spark, tmpdir_path)) == first
    coded = encode(load("z", "z", None, "new"), "v", tmpdir_path, "code", prefix="NEW_")
    assert rows(coded) == [(None, None), ("new", None), ("z", "NEW_4"), ("z", "NEW_4")]


# ---------------------------------------------------------------- mergeable profiles

def test_merged_profiles_meet_the_exact_one(spark):
    line = spark.read.parquet(f"{SF001}/lineitem.parquet")
    df = line.select(F.trunc(F.col("l_shipdate").cast("date"), "month").alias("month"), "l_orderkey", "l_quantity",
                     (F.col("l_extendedprice") + 1e9).alias("price"), "l_returnflag")
    old, new = df.where("l_orderkey % 3 > 0"), df.where("l_orderkey % 3 = 0")  # the rows of a month come in two loads
    parts = profile_parts(old, ["month"]).unionByName(profile_parts(new, ["month"]))
    got = {(r.column, r.metric): r.value for r in merge_profiles(parts).collect()}
    cols = ["l_orderkey", "l_quantity", "price", "l_returnflag"]
    want = {(r.column, r.metric): r.value for r in profile(df, cols).collect()}
    n = df.count()
    for (column, metric), value in want.items():
        if metric == "n_unique":
            assert abs(got[column, "n_unique_approx"] - value) <= 3 * 0.0163 * value + 1
        elif metric in ("p25", "p50", "p75"):
            q = int(metric[1:]) / 100
            at = got[column, f"{metric}_approx"]
            below, upto = df.where(F.col(column) < at).count() / n, df.where(F.col(column) <= at).count() / n
            assert below - 0.01 <= q <= upto + 0.01
        else:
            assert got[column, metric] == pytest.approx(value, rel=1e-9, abs=1e-9)


def test_merged_profiles_of_nulls_one_value_and_empty_tables(spark):
    df = spark.createDataFrame([("a", None, "s"), ("a", None, None), ("b", 5.0, None)], "part string, x double, s string")
    got = {(r.part, r.column, r.metric): r.value for r in merge_profiles(profile_parts(df, ["part"]), ["part"]).collect()}
    assert got["a", "x", "n_missing"] == 2 and got["a", "x", "n_unique_approx"] == 0 and ("a", "x", "mean") not in got
    assert got["b", "x", "mean"] == got["b", "x", "p50_approx"] == 5 and got["b", "x", "sd"] is None
    both = {(r.column, r.metric): r.value for r in merge_profiles(profile_parts(df, ["part"])).collect()}
    assert both["x", "mean"] == 5 and both["x", "n_missing"] == 2 and both["s", "n_unique_approx"] == 1
    assert profile_parts(df.limit(0), ["part"]).count() == 0 and merge_profiles(profile_parts(df.limit(0), ["part"])).count() == 0


# ---------------------------------------------------------------- input order

def test_ties_and_names_in_input_order_at_any_partitioning(spark, tmpdir_path):
    rng = random.Random(3)
    data = [(i, rng.choice(["pear", "fig", None, "apple"]), rng.randrange(5)) for i in range(4000)]
    spark.createDataFrame(data, "i int, name string, k int").coalesce(1).write.option("header", True).csv(f"{tmpdir_path}/t")
    want = [i for i, _, _ in sorted(data, key=lambda r: r[2])]
    seen = list(dict.fromkeys(r[1] for r in data))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (before, "2000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            df = with_position(spark.read.schema("i int, name string, k int").option("header", True).csv(f"{tmpdir_path}/t"))
            got = [r.i for r in stable_sort_index(df, ["k"]).orderBy("row_index").collect()]
            assert got == want
            names = first_appearance(df, "name")
            assert names == seen
            wide = pivot_wider(df.groupBy("k", "name").count(), "name", "count", values=names, sort_names=False)
            assert wide.columns == ["k", *["NA" if x is None else x for x in seen]]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    with pytest.raises(ValueError):
        first_appearance(df, "i", max_names=10)
