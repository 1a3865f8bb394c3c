import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from metaweave.operators import joins  # noqa: F401
from metaweave.operators import (
    flag_membership, full_join_na, join_all_na, join_na, join_on, match_any, natural_join, restrict_to, shared_keys,
)
from tests.conftest import rows


@pytest.fixture
def null_keys(spark):
    # null key on the left only, right only, both; duplicate keys on either side
    left = spark.createDataFrame([(1, "l1"), (2, "l2"), (2, "l2b"), (None, "lnull"), (4, "l4")],
                                 "sample_id int, v string")
    right = spark.createDataFrame([(1, "r1"), (2, "r2"), (None, "rnull"), (None, "rnull2"), (5, "r5")],
                                  "sample_id int, v string")
    return left, right


def test_shared_keys_pattern(spark):
    a = spark.createDataFrame([], "case_id string, sample_id string, analyte_type string, status string")
    b = spark.createDataFrame([], "sample_id string, case_id string, status string")
    assert shared_keys(a, b) == ["case_id", "sample_id"]
    assert shared_keys(a, b, pattern=None) == ["case_id", "sample_id", "status"]


def test_inner_null_matches_null(null_keys):
    left, right = null_keys
    out = join_na(left, right, ["sample_id"], how="inner")
    assert out.columns == ["sample_id", "v_x", "v_y"]
    assert rows(out) == [(None, "lnull", "rnull"), (None, "lnull", "rnull2"), (1, "l1", "r1"),
                         (2, "l2", "r2"), (2, "l2b", "r2")]
    plain = join_na(left, right, ["sample_id"], how="inner", null_equal=False)
    assert plain.count() == 3


@pytest.mark.parametrize("skew_safe", [True, False])
def test_full_join_skew_safe_equals_plain(null_keys, skew_safe):
    left, right = null_keys
    out = join_na(left, right, ["sample_id"], how="full", suffix=("_analyte", "_aliquot"), skew_safe_full=skew_safe)
    assert out.columns == ["sample_id", "v_analyte", "v_aliquot"]
    assert rows(out) == [(None, "lnull", "rnull"), (None, "lnull", "rnull2"), (1, "l1", "r1"), (2, "l2", "r2"),
                         (2, "l2b", "r2"), (4, "l4", None), (5, None, "r5")]


def test_full_join_multi_key_nulls(spark):
    a = spark.createDataFrame([(None, 1, "a"), (None, None, "b"), (3, 3, "c")], "k1 int, k2 int, x string")
    b = spark.createDataFrame([(None, 1, "A"), (None, 2, "B"), (3, 3, "C")], "k1 int, k2 int, y string")
    out = full_join_na(a, b, by=["k1", "k2"])
    assert rows(out) == [(None, None, "b", None), (None, 1, "a", "A"), (None, 2, None, "B"), (3, 3, "c", "C")]


def test_left_and_right_key_names(spark):
    o = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "o_key int, o_cust int")
    cu = spark.createDataFrame([(10, "n10"), (20, "n20")], "c_key int, c_name string")
    out = join_on(o, cu, {"o_cust": "c_key"}, how="left")
    assert out.columns == ["o_key", "o_cust", "c_name"]
    assert rows(out) == [(1, 10, "n10"), (2, 20, "n20"), (3, None, None)]


def test_right_column_named_like_left_key_gets_suffix(spark):
    a = spark.createDataFrame([(1, "x")], "a int, v string")
    b = spark.createDataFrame([(1, 99)], "b int, a int")
    out = join_on(a, b, {"a": "b"})
    assert out.columns == ["a", "v", "a_y"]


def test_case_insensitive_collision_is_suffixed(spark):
    a = spark.createDataFrame([(1, "x")], "k int, Sample_Type string")
    b = spark.createDataFrame([(1, "y")], "k int, sample_type string")
    out = join_na(a, b, ["k"])
    assert out.columns == ["k", "Sample_Type_x", "sample_type_y"]


def test_natural_join(spark):
    a = spark.createDataFrame([(1, "a"), (None, "n")], "doc_id int, x string")
    b = spark.createDataFrame([(1, 5), (None, 6)], "doc_id int, q int")
    assert rows(natural_join(a, b)) == [(None, "n", 6), (1, "a", 5)]
    with pytest.raises(ValueError):
        natural_join(a, spark.createDataFrame([], "zzz int"))


def test_join_all_suffix_policy(spark):
    t = {
        "customer": spark.createDataFrame([(1, "c1"), (2, "c2")], "cust_id int, name string"),
        "orders": spark.createDataFrame([(1, 3, 9.0)], "cust_id int, n long, top double"),
        "events": spark.createDataFrame([(2, 4, 1.0), (7, 1, 2.0)], "cust_id int, n long, top double"),
    }
    out = join_all_na(t, by=["cust_id"])
    assert out.columns == ["cust_id", "name", "n_orders", "top_orders", "n_events", "top_events"]
    assert rows(out) == [(1, "c1", 3, 9.0, None, None), (2, "c2", None, None, 4, 1.0), (7, None, None, None, 1, 2.0)]


@pytest.fixture
def id_set_with_null(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (4,)], "case_id int")
    ids = spark.createDataFrame([(1,), (None,)], "id int")
    ids_no_null = spark.createDataFrame([(1,)], "id int")
    return df, ids, ids_no_null


def test_semi_anti_null_semantics(id_set_with_null):
    df, ids, ids_no_null = id_set_with_null
    assert rows(restrict_to(df, ids, "case_id")) == [(None,), (1,)]
    assert rows(restrict_to(df, ids, "case_id", keep=False)) == [(2,), (4,)]
    # without a NULL in the set, NOT IN keeps the NULL row (never "x NOT IN (..., NULL)" = 0 rows)
    assert rows(restrict_to(df, ids_no_null, "case_id", keep=False)) == [(None,), (2,), (4,)]
    # invariant: semi + anti = all
    for s in (ids, ids_no_null):
        assert restrict_to(df, s, "case_id").count() + restrict_to(df, s, "case_id", keep=False).count() == df.count()


def test_restrict_by_derived_key(spark):
    df = spark.createDataFrame([("S-01A",), ("S-01B",), ("T-01A",)], "sample string")
    excl = spark.createDataFrame([("S-01",)], "id string")
    out = restrict_to(df, excl, "sample", keep=False, derive=lambda c: F.regexp_replace(c, ".$", ""),
                      derive_ids=lambda c: c)
    assert rows(out) == [("T-01A",)]


def test_empty_id_set(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    empty = spark.createDataFrame([], "id int")
    assert restrict_to(df, empty, "k").count() == 0
    assert restrict_to(df, empty, "k", keep=False).count() == 2


def test_flag_membership_no_fanout(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    ids = spark.createDataFrame([("a",), ("a",), ("a",)], "id string")
    out = flag_membership(df, ids, "k", "hit", true_value="MATCH", false_value=None)
    assert rows(out) == [(None, None), ("a", "MATCH"), ("b", None)]


@pytest.mark.parametrize("mode", ["prefix", "regex"])
def test_match_any(spark, mode):
    df = spark.createDataFrame([(1, "red box"), (2, "blue cup"), (3, "green"), (4, None), (5, "red box")],
                               "id int, name string")
    pats = spark.createDataFrame([("red",), ("blue",)] if mode == "prefix" else [("^red",), ("^blue",)], "p string")
    assert rows(match_any(df, "name", pats, mode=mode), "id") == [(1,), (2,), (5,)]
    assert rows(match_any(df, "name", pats, mode=mode, keep=False), "id") == [(3,)]
    empty = spark.createDataFrame([], "p string")
    assert match_any(df, "name", empty, mode=mode).count() == 0


def test_match_any_prefix_of_any_length(spark):
    df = spark.createDataFrame([(1, "abcdef"), (2, "abx"), (3, "zzz"), (4, "ab"), (5, "")], "id int, name string")
    pats = spark.createDataFrame([("abc",), ("abx",), ("a",), ("q",), ("abcdefg",)], "p string")
    assert rows(match_any(df, "name", pats, mode="prefix"), "id") == [(1,), (2,), (4,)]
    assert len(rows(match_any(df, "name", spark.createDataFrame([("",)], "p string"), mode="prefix"))) == 5


@pytest.mark.parametrize("blocks", [1, 7, 32])
def test_match_any_regex_blocks(spark, blocks):
    df = spark.createDataFrame([(i, f"s{i:03d}x") for i in range(40)], "id int, name string")
    pats = spark.createDataFrame([(f"^s{i:03d}",) for i in range(0, 40, 2)], "p string")
    assert rows(match_any(df, "name", pats, mode="regex", blocks=blocks), "id") == [(i,) for i in range(0, 40, 2)]


def test_match_any_with_more_patterns_than_any_former_limit(spark):
    df = spark.range(30_000).select("id", F.format_string("n%06dz", "id").alias("name"))
    pats = spark.range(0, 30_000, 2).select(F.format_string("n%06d", "id").alias("p"))
    assert match_any(df, "name", pats, mode="prefix").agg(F.count(F.lit(1)), F.sum(F.col("id") % 2)).first()[:] == (15_000, 0)


def test_join_all_names_by_case_mixed_key_types_and_found_keys(spark):
    a = spark.createDataFrame([(1, "a")], "case_id int, V string")
    b = spark.createDataFrame([(1, "b"), (2, "c")], "case_id long, v string")
    d = spark.createDataFrame([("2", "d")], "case_id string, w string")
    out = join_all_na({"a": a, "b": b, "d": d})
    assert out.columns == ["case_id", "V_a", "v_b", "w"]
    assert rows(out) == [("1", "a", "b", None), ("2", None, "c", "d")]


def test_full_join_reads_each_input_once(spark, tmp_path):
    spark.range(5).select(F.col("id").alias("k"), F.lit("l").alias("x")).write.parquet(f"{tmp_path}/l")
    left = spark.read.parquet(f"{tmp_path}/l")
    out = join_na(left, spark.range(3, 8).select(F.col("id").alias("k"), F.lit("r").alias("y")), ["k"], how="full")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert f"{tmp_path}/l" not in str(out.inputFiles()) and "FullOuter" not in plan
    assert len(rows(out)) == 8


def test_join_all_matches_pairwise_fold_with_dups_and_nulls(spark):
    a = spark.createDataFrame([(1, "a1"), (1, "a1b"), (None, "an"), (2, "a2")], "k int, x string")
    b = spark.createDataFrame([(1, "b1"), (None, "bn"), (3, "b3")], "k int, y string")
    d = spark.createDataFrame([(1, "d1"), (1, "d1b"), (4, "d4"), (None, "dn")], "k int, z string")
    nway = join_all_na({"a": a, "b": b, "d": d}, by=["k"])
    fold = join_na(join_na(a, b, ["k"], how="full"), d, ["k"], how="full")
    assert nway.columns == fold.columns == ["k", "x", "y", "z"]
    assert rows(nway) == rows(fold)
    assert len(rows(nway)) == 4 + 1 + 3  # key 1: 2x1x2, NULL: 1x1x1, keys 2, 3, 4 one row each


def _product(tables, how):
    """Every combination of the rows of a key; a table without the key counts as one row of NULLs (``how`` permitting)."""
    out = []
    for k in {r[0] for t in tables for r in t}:
        parts = [[r[1:] for r in t if r[0] == k] for t in tables]
        if how == "inner" and not all(parts) or how == "left" and not parts[0]:
            continue
        parts = [p or [(None,) * (len(t[0]) - 1)] for p, t in zip(parts, tables)]
        out += [(k, *[v for r in combo for v in r]) for combo in itertools.product(*parts)]
    return sorted(out, key=str)


def _three_tables(n_hot=60):
    a = [(1, "a1")] * 2 + [(None, f"n{i}") for i in range(7)] + [(5, f"h{i}") for i in range(n_hot)] + [(2, None)]
    b = [(1, 10), (None, 11), (5, None), (9, 12)] + [(5, i) for i in range(25)]
    d = [(5, 0.5), (5, 1.5), (2, 2.5), (7, 3.5), (None, 4.5)]
    return a, b, d


@pytest.mark.parametrize("how", ["full", "inner", "left"])
@pytest.mark.parametrize("cell_rows,listed", [(10_000, 100), (10, 100), (10, 0), (1, 100)])
def test_join_all_equals_the_product_of_each_key(spark, monkeypatch, how, cell_rows, listed):
    """At any number of cells, with hot keys listed or joined as a table."""
    monkeypatch.setattr(joins, "HOT_LISTED", listed)
    tables = _three_tables()
    frames = {n: spark.createDataFrame(t, s) for n, t, s in zip("abd", tables, ("k int, x string", "k int, y long", "k int, z double"))}
    out = join_all_na(frames, by=["k"], how=how, cell_rows=cell_rows)
    assert out.columns == ["k", "x", "y", "z"]
    assert sorted(map(tuple, out.collect()), key=str) == _product(tables, how)


def test_join_all_moves_rows_once(spark):
    frames = {f"t{i}": spark.range(0, 2000).select((F.col("id") * (i + 1)).alias("k"), F.col("id").alias(f"v{i}")) for i in range(5)}
    out = join_all_na(frames, by=["k"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert out.count() == len({k * (i + 1) for i in range(5) for k in range(2000)})


def test_join_all_deals_a_hot_key_over_cells(spark):
    """A third of the rows share a key; no group holds more than a few cells' worth of them."""
    n = 6000
    a = spark.range(0, n).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("k"), F.col("id").alias("a"))
    b = spark.createDataFrame([(None, 1), (None, 2), (4, 3)], "k long, b int")
    d = spark.range(0, 10).select(F.col("id").alias("k"), F.col("id").alias("d"))
    out = join_all_na({"a": a, "b": b, "d": d}, by=["k"], cell_rows=100)
    assert out.where("k IS NULL").count() == 2 * n // 3
    assert out.where("k IS NULL AND d IS NOT NULL").count() == 0 and out.where("k = 4").count() == 1
    counts = out.groupBy("a").count().where("a % 3 = 0").agg(F.min("count"), F.max("count")).first()
    assert tuple(counts) == (2, 2)


def test_join_all_of_tables_with_keys_only_and_empty_tables(spark):
    a = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    b = spark.createDataFrame([], "k int, y int")
    assert rows(join_all_na({"a": a, "b": b}, by=["k"])) == [(None, None), (1, None), (1, None)]
    assert join_all_na({"a": a, "b": b}, by=["k"], how="inner").count() == 0
    assert join_all_na({"a": b, "b": b}, by=["k"]).columns == ["k", "y_a", "y_b"]


@pytest.mark.parametrize("how", ["full", "inner", "left"])
def test_join_all_of_unique_tables_needs_no_search_and_checks_them(spark, how):
    tables = [[(1, "a"), (None, "n"), (2, "b")], [(1, 10), (3, 11)], [(1, 0.5), (1, 1.5), (2, 2.5), (None, 1.0)]]
    frames = {n: spark.createDataFrame(t, s) for n, t, s in zip("abd", tables, ("k int, x string", "k int, y long", "k int, z double"))}
    out = join_all_na(frames, by=["k"], how=how, unique=["a", "b"])
    assert sorted(map(tuple, out.collect()), key=str) == _product(tables, how)
    with pytest.raises(Exception, match="not unique"):
        join_all_na(frames, by=["k"], how=how, unique=["a", "b", "d"]).collect()


LITERALS = [
    ("^s001x", ["s00", "001", "01x"]), ("ab+cde", ["cde"]), ("abc?", []), ("abcd?", ["abc"]), ("abc{2}def", ["def"]), ("a.bcd", ["bcd"]),
    (r"abc\.def", ["abc", "def"]), ("[abc]defg", ["def", "efg"]), ("(abc)+def", ["def"]), ("(ab(c|d)e)?fgh", ["fgh"]), ("(?i)abc", []), ("abc|def", []),
    (r"\x41bcd", []), (r"\Qabc\E", []), ("[]a]bcd", []), ("[a[b]]bcd", []), ("", []), ("ab", []), ("abc*?def", ["def"]), ("(abc", []), ("éüö", ["éüö"]),
]


def test_required_literals(spark):
    df = spark.createDataFrame([(p,) for p, _ in LITERALS], "p string")
    got = {r[0]: sorted(r[1]) for r in df.select("p", joins.required_literals(F.col("p"))).collect()}
    assert got == {p: sorted(x) for p, x in LITERALS}


REGEXES = ["^al.ha", "bet[ab]", "gam+a", "x?delta", "(eps|zeta)1", "eta|theta$", "(?i)IOTA", r"kap\.pa", r"\d{3}-lam", "m.", "nu{2,}xx", "", "a|", "omicron.*pi", "rho+", "sig(ma)?", "^$", "tau\\b"]


@pytest.mark.parametrize("loose", [10_000, 2])
@pytest.mark.parametrize("regexes", [REGEXES, [r for r in REGEXES if r not in ("", "a|")], REGEXES[:4], ["zzz", "qqq"]])
def test_match_any_regex_equals_brute_force(spark, monkeypatch, regexes, loose):
    monkeypatch.setattr(joins, "LOOSE_PATTERNS", loose)
    rng = random.Random(1)
    words = ["alpha", "alha", "beta", "betb", "gamma", "gama", "delta", "xdelta", "eps1", "zeta1", "eta", "theta", "thetax", "iota", "IoTa", "kap.pa", "kappa", "123-lam", "12-lam", "m", "mx", "nuuxx", "nuxx", "omicron", "pi", "rhooo", "rh", "sig", "sigma", "", "tau", "taux"]
    values = ["".join(rng.choices(words, k=rng.randint(0, 3))) for _ in range(300)] + [" ".join(rng.choices(words, k=3)) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(values)) + [(-1, None)], "id int, name string")
    pats = spark.createDataFrame([(r,) for r in regexes] + [(None,), (regexes[0],)], "p string")
    want = {i for i, v in enumerate(values) if any(re.search(r, v) for r in regexes)}
    assert {r["id"] for r in match_any(df, "name", pats).collect()} == want
    assert {r["id"] for r in match_any(df, "name", pats, keep=False).collect()} == set(range(500)) - want


def test_match_any_regex_meets_few_patterns(spark):
    """10,000 patterns over 20,000 values: the index leads each value to a handful of them."""
    df = spark.range(20_000).select("id", F.format_string("sample-%05d-x", "id").alias("name"))
    pats = spark.range(0, 20_000, 2).select(F.format_string("^sample-%05d-[xy]$", "id").alias("p"))
    out = match_any(df, "name", pats)
    assert out.agg(F.count(F.lit(1)), F.sum(F.col("id") % 2)).first()[:] == (10_000, 0)
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()


def test_match_any_regex_broadcasts_no_pieces_of_values(spark):
    """More patterns than are broadcast: whatever sizes the planner guesses, pieces, patterns and values meet by merge joins."""
    df = spark.range(21_000).select("id", F.format_string("part %07d", "id").alias("name"))
    pats = spark.range(2, 21_002, 2).select(F.format_string("^part( |-)0*%d$", "id").alias("p"))
    out = match_any(df, "name", pats)
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.agg(F.count(F.lit(1)), F.sum(F.col("id") % 2)).first()[:] == (10_499, 0)


def test_required_literals_of_several_lengths(spark):
    df = spark.createDataFrame([("^part.*0012345$",), ("ab.cde",), ("abcdefgh.xyzuv",)], "p string").coalesce(1)
    got = [sorted(r[0]) for r in df.select(joins.required_literals(F.col("p"), (3, 5, 7))).collect()]
    assert got == [["0012345", "art", "par"], ["cde"], ["abcdefg", "bcdefgh", "xyzuv"]]
