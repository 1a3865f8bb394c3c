"""Every registered query against its DuckDB oracle on sf0.01, plus plan checks."""

import pytest

from __spark_entry__ import entry
from metaweave.plans import oracle_sql, queries
from tests.conftest import SF001, SF01
from tools.check_oracle import TABLES, compare, type_diffs

QUERIES = queries()
SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return con


def test_every_query_has_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF01)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    ok, msg = compare(got, df.columns, cur.fetchall(), [d[0] for d in cur.description])
    assert ok, msg
    assert not type_diffs(dict(df.dtypes), {d[0]: str(d[1]) for d in cur.description})


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0 and df.columns[0] == "center"


@pytest.mark.parametrize("name", ["rna_table", "assay_table", "keep_first", "semi_cohort", "pivot_counts",
                                  "shared_keys_full_join", "match_any_prefix", "drop_replicates"])
def test_plans_stay_in_jvm_and_avoid_cross_products(spark, name):
    plan = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_parquet_scans_are_pruned(spark):
    df = QUERIES["natural_inner"](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string,n_chars:bigint>" in plan  # no `text`


def test_result_independent_of_shuffle_partitions(spark):
    a = sorted(map(tuple, QUERIES["rna_table"](spark, SF001).collect()), key=str)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        b = sorted(map(tuple, QUERIES["rna_table"](spark, SF001).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_plan_is_jvm_only_and_has_no_cartesian(spark, name):
    plan = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "PythonUDF" not in plan
    assert "CartesianProduct" not in plan
    if name != "match_any_pattern":  # regex patterns: a nested loop over a bounded, broadcast pattern chunk
        assert "BroadcastNestedLoopJoin" not in plan
