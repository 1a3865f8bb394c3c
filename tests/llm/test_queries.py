"""Registered corpus queries on sf0.01: against DuckDB where SQL expresses them, else their contract's columns and rows."""

import duckdb
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from metaweave.llm.queries import ORACLE_SQL, QUERIES
from tools.check_oracle import compare, type_diffs

SF = "/root/testdata/sf0.01"
COLUMNS = {
    "op1": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op5": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op6": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op8": "page_id url text n_chars",
    "op9": "doc_id fingerprint component_id",
    "op11": "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256",
    "op13": "doc_id n_shingles component_id kept",
}


def test_all_are_registered():
    assert [f"op{n}" for n in range(1, 14)] == sorted((q.split("_")[0] for q in QUERIES), key=lambda x: int(x[2:]))
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLE_SQL) <= set(oracle_sql())
    assert queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    got, kinds = [tuple(r) for r in df.collect()], dict(df.dtypes)
    cur = con.execute(ORACLE_SQL[name])
    names, types = [d[0] for d in cur.description], {d[0]: str(d[1]) for d in cur.description}
    ok, message = compare(got, df.columns, cur.fetchall(), names)
    assert ok, message
    assert not type_diffs(kinds, types)


@pytest.mark.parametrize("name", sorted(q for q in QUERIES if q.split("_")[0] in COLUMNS))
def test_columns_and_rows(spark, name):
    df = QUERIES[name](spark, SF)
    wanted = COLUMNS[name.split("_")[0]].split()
    assert df.columns[: len(wanted)] == wanted
    table = "pages" if "page_id" in wanted else "documents"
    key = wanted[0]
    assert df.select(key).distinct().count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
