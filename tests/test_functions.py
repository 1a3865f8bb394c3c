import pytest
from pyspark.sql import functions as F

from metaweave.functions import (
    all_null, case_when, coalesce_ids, concat_na, detect, drop_last, drop_suffix_regex, extract, if_else,
    is_in_values, last_chars, recode, rewrite_path, str_sub, sub_first,
)
from tests.conftest import rows


@pytest.fixture
def cond(spark):
    # cond_null fixture: true / false / null conditions and a value column
    return spark.createDataFrame([(1, True, "a"), (2, False, "b"), (3, None, None), (4, True, "z")],
                                 "id int, c boolean, v string")


def test_if_else_null_condition_gives_null(cond):
    out = cond.select("id", if_else(F.col("c"), "yes", "no").alias("r"))
    assert rows(out) == [(1, "yes"), (2, "no"), (3, None), (4, "yes")]


def test_case_when_no_match_and_null_condition(cond):
    out = cond.select("id", case_when((F.col("v") == "a", "A"), (F.col("v") == "b", "B")).alias("r"))
    assert rows(out) == [(1, "A"), (2, "B"), (3, None), (4, None)]


def test_recode_passthrough_and_mapped_null(cond):
    out = cond.select("id", recode("v", {"a": "AA", "b": None}).alias("r"))
    assert rows(out) == [(1, "AA"), (2, None), (3, None), (4, "z")]


def test_recode_duplicate_keys(cond):
    pairs = [("a", "first"), ("a", "second")]
    with pytest.raises(ValueError):
        recode("v", pairs)
    first = cond.select("id", recode("v", pairs, duplicate_key="first").alias("r")).filter("id = 1").first()
    last = cond.select("id", recode("v", pairs, duplicate_key="last").alias("r")).filter("id = 1").first()
    assert (first.r, last.r) == ("first", "second")


def test_recode_numbers_to_words_and_any_default_text(cond):
    out = cond.select("id", recode("id", [(1, "one"), (2, None)]).alias("r"), recode("v", {"a": "AA"}, default="passthrough").alias("s"))
    got = {r["id"]: (r["r"], r["s"]) for r in out.collect()}
    assert got[1][0] == "one" and got[2][0] is None and got[3][0] == "3"
    assert {s for _, s in got.values()} <= {"AA", "passthrough"}
    kept = cond.select(recode("id", [(1, 10), (2, None)]).alias("r"))
    assert kept.schema["r"].dataType.simpleString() in ("int", "bigint")


def test_recode_default(cond):
    out = cond.select("id", recode("v", {"a": "AA"}, default="other").alias("r"))
    assert rows(out) == [(1, "AA"), (2, "other"), (3, "other"), (4, "other")]


def test_concat_na(cond):
    out = cond.select("id", concat_na(F.lit("NEW_"), F.col("v")).alias("r"),
                      concat_na(F.lit("NEW_"), F.col("v"), na_text="NA").alias("s"))
    got = {r.id: (r.r, r.s) for r in out.collect()}
    assert got[3] == (None, "NEW_NA") and got[1] == ("NEW_a", "NEW_a")


def test_all_null_and_membership(spark):
    df = spark.createDataFrame([(None, None), ("x", None), (None, "y")], "a string, b string")
    assert df.filter(all_null(["a", "b"])).count() == 1
    assert df.filter(is_in_values("a", ["x"])).count() == 1
    assert df.filter(~is_in_values("a", ["x"])).count() == 2  # NULL is "not in" and is kept
    assert df.filter(is_in_values("a", ["x", None])).count() == 3


def test_coalesce_ids(spark):
    df = spark.createDataFrame([("reg", "tmp"), (None, "tmp")], "a string, b string")
    assert rows(df.select(coalesce_ids("a", "b"))) == [("reg",), ("tmp",)]


def test_barcode_parts(spark):
    df = spark.createDataFrame([("PRJ-AA-0001-01A-11R",), ("ab",), (None,)], "x string")
    out = df.select(str_sub("x", 1, 11).alias("case"), str_sub("x", 1, 14).alias("sample"),
                    drop_last("x", 1).alias("dl"), drop_suffix_regex("x", "-.{3}").alias("ds"),
                    last_chars("x", 3).alias("l3"), extract("x", "[0-9]{2}R$").alias("ex"))
    got = rows(out)
    assert got[0] == (None, None, None, None, None, None)
    assert ("ab", "ab", "a", "ab", None, None) in got  # short strings: unchanged / NULL, never ''
    assert ("PRJ-AA-0001", "PRJ-AA-0001-01", "PRJ-AA-0001-01A-11", "PRJ-AA-0001-01A", "11R", "11R") in got


def test_sub_first_and_detect(spark):
    df = spark.createDataFrame([("a.tsv.tsv",), ("b$x",)], "x string")
    out = df.select(sub_first("x", r"\.tsv", "").alias("r"), sub_first("x", r"\$", "$$").alias("d"),
                    detect("x", "tsv$").alias("t"))
    assert rows(out) == [("a.tsv", "a.tsv.tsv", True), ("b$x", "b$$x", False)]


def test_rewrite_path_literal_vs_regex_quirk(spark):
    df = spark.createDataFrame([("abbam.bam",)], "f string")
    lit_ = df.select(rewrite_path("f", "/d/", ".bam", "_unmapped.bam")).first()[0]
    quirk = df.select(rewrite_path("f", "", ".bam", "_u.bam", literal=False)).first()[0]
    assert lit_ == "/d/abbam_unmapped.bam"
    assert quirk == "a_u.bam_u.bam"
