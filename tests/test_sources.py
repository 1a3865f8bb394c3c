from metaweave import sources
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from pyspark.sql.types import StringType

from metaweave.operators import add_constants, apply_by_type, catalog_columns, conform, relocate, select_range
from metaweave.sources import (
    id_table, read_checkpoint, null_scaffold, read_catalog, read_commented_tsv, read_csv, read_json_array, read_json_array_ranges, read_tsv, save_tables,
    write_csv, write_csv_indexed, write_tsv,
)
from tests.conftest import rows


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)
    return path


def _read_parts(folder):
    out = []
    for p in sorted(glob.glob(os.path.join(folder, "part-*"))):
        with open(p) as fh:
            out.append(fh.read())
    return "".join(out)


def test_tsv_na_and_blank_are_null(spark, tmpdir_path):
    p = _write(os.path.join(tmpdir_path, "a.tsv"), "id\tv\n1\tNA\n2\t\n3\tx\n")
    assert rows(read_tsv(spark, p)) == [("1", None), ("2", None), ("3", "x")]


def test_catalog_one_reader_per_file(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, "sample.tsv"), "sample_id\tt\ns1\tPrimary Tumor\n")
    _write(os.path.join(tmpdir_path, "portion.tsv"), "portion_id\tis_ffpe\np1\tFALSE\n")
    cat = read_catalog(spark, tmpdir_path)
    assert sorted(cat) == ["portion", "sample"]
    cols = catalog_columns(spark, cat)
    assert rows(cols, "table", "column") == [("portion", "is_ffpe"), ("portion", "portion_id"), ("sample", "sample_id"),
                                             ("sample", "t")]


def test_csv_dotted_names(spark, tmpdir_path):
    p = _write(os.path.join(tmpdir_path, "w.csv"), '"Archive.Donor","Size..bytes."\n"DO1",1.54E+11\n')
    df = read_csv(spark, p, sanitize=True)
    assert df.columns == ["Archive_Donor", "Size__bytes_"]
    assert df.select(F.col("Size__bytes_").try_cast("double")).first()[0] == 1.54e11


def test_commented_tsv(spark, tmpdir_path):
    p = _write(os.path.join(tmpdir_path, "c.txt"), "#comment\n#more\nPATIENT_ID\tAGE\nP1\t61\n")
    df = read_commented_tsv(spark, p)
    assert df.columns == ["PATIENT_ID", "AGE"] and df.count() == 1


def test_json_array(spark, tmpdir_path):
    objs = [{"file_name": f"f{i}.bam", "sample_barcode": f"S{i}", "file_size": 2**40 + i, "analysis_type": None}
            for i in range(3)]
    p = _write(os.path.join(tmpdir_path, "m.json"), json.dumps(objs, indent=2))
    df = read_json_array(spark, p)
    assert df.count() == 3 and dict(df.dtypes)["file_size"] == "bigint"


ODD = [
    {"k": 1, "s": "plain", "o": None}, {"k": 2, "s": 'a "}", {"b": [', "o": {"x": [1, 2], "y": "}]"}}, {"k": 3, "s": "\\\\\"", "o": {"x": [], "y": None}},
    {"k": 4, "s": "}}}}{{{{", "o": {"x": [3], "y": "[[["}}, {"k": 5, "s": "zwei\nZeilen \u00e4 ]", "o": None}, {"k": None, "s": None, "o": {"x": None, "y": "\\\\"}},
    {"k": 7, "s": ",,[", "o": {"x": [7], "y": "{"}},
]


@pytest.mark.parametrize("size", [7, 64, 100_000])
@pytest.mark.parametrize("indent", [None, 2])
def test_json_array_by_ranges(spark, tmpdir_path, size, indent):
    """Ranges of a few bytes, so that strings, escapes and objects lie across their borders; two files with states of their own."""
    objs = [ODD[i % len(ODD)] for i in range(40)]
    folder = os.path.join(tmpdir_path, "arrays")
    os.mkdir(folder)
    for name, own, ascii_only in (("a.json", objs, True), ("b.json", objs[:9], False), ("none.json", [], True)):
        _write(os.path.join(folder, name), json.dumps(own, indent=indent, ensure_ascii=ascii_only))
    _write(os.path.join(folder, "empty.json"), "")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        got = read_json_array_ranges(spark, folder, "k long, s string, o struct<x: array<long>, y: string>").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = objs + objs[:9]
    assert sorted(json.dumps(r.asDict(True), sort_keys=True) for r in got) == sorted(json.dumps(x, sort_keys=True) for x in want)


@pytest.mark.parametrize("text", ['[{"k": 1}, {"k": 2', '[{"k": 1}, "a"]', '[{"k": "text"}]', '[1, {"k": 1}]', "[[{\"k\": 1}]]"])
def test_json_array_by_ranges_refuses(spark, tmpdir_path, text):
    p = _write(os.path.join(tmpdir_path, "bad.json"), text)
    with pytest.raises(Exception):
        read_json_array_ranges(spark, p, "k long").collect()


def test_writers_na_policy(spark, tmpdir_path):
    df = spark.createDataFrame([("a", None), ("b", "x")], "k string, v string").withColumn("z", F.lit(None))
    write_tsv(df, os.path.join(tmpdir_path, "t"))
    text = _read_parts(os.path.join(tmpdir_path, "t"))
    assert "a\tNA\tNA" in text
    write_csv(df, os.path.join(tmpdir_path, "c"))
    assert '"k","v","z"' in _read_parts(os.path.join(tmpdir_path, "c"))
    write_csv_indexed(df, os.path.join(tmpdir_path, "i"), order_by=["k"])
    back = read_csv(spark, os.path.join(tmpdir_path, "i"))
    assert back.columns[0] == "_c0" and rows(back, "_c0", "k") == [("1", "a"), ("2", "b")]
    assert read_csv(spark, os.path.join(tmpdir_path, "i"), drop_index=True).columns == ["k", "v", "z"]
    paths = save_tables({"one": df}, os.path.join(tmpdir_path, "ck"))
    back = read_checkpoint(spark, paths["one"])
    assert back.count() == 2 and dict(back.dtypes)["z"] == "string"  # void column typed on write


def test_scaffold_and_conform(spark):
    ids = id_table(spark, ["S1", "S2"])
    tmpl = [("Country", "string"), ("Local_Sample_ID", "string"), ("Is_Normal", "string"), ("n", "int")]
    sc = null_scaffold(ids, tmpl, id_column="Local_Sample_ID", fill={"Country": "USA"})
    assert rows(sc) == [("USA", "S1", None, None), ("USA", "S2", None, None)]
    assert dict(sc.dtypes)["n"] == "int"
    df = spark.createDataFrame([("x", "12"), ("y", "bad")], "extra string, n string")
    out = conform(df, tmpl)
    assert out.columns == ["Country", "Local_Sample_ID", "Is_Normal", "n"]
    assert rows(out, "n") == [(None,), (12,)]


def test_names_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    assert select_range(df, "b", "d").columns == ["b", "c", "d"]
    assert relocate(df, "d", before="b").columns == ["a", "d", "b", "c"]
    assert relocate(df, "a", after="c").columns == ["b", "c", "a", "d"]


def test_apply_by_type_and_constants(spark):
    df = spark.createDataFrame([("ab", 1), (None, 2)], "s string, n int")
    up = apply_by_type(df, lambda t: isinstance(t, StringType), F.upper)
    assert rows(up) == [(None, 2), ("AB", 1)]
    out = add_constants(df, {"Platform": ("RNA_seq", "string"), "MetastaticSite": (None, "string")})
    assert dict(out.dtypes)["MetastaticSite"] == "string"
    assert rows(out, "Platform", "MetastaticSite") == [("RNA_seq", None), ("RNA_seq", None)]


def test_json_lines_and_positions(spark, tmpdir_path):
    from metaweave.operators import drop_positions, select_positions
    from metaweave.sources import read_json_lines

    p = _write(os.path.join(tmpdir_path, "m.jsonl"), '{"a": 1, "b": "x", "c": null}\n{"a": 2, "b": null, "c": 3}\n')
    df = read_json_lines(spark, p)
    assert sorted(df.columns) == ["a", "b", "c"] and df.count() == 2
    wide = spark.createDataFrame([(1, 2, 3, 4)], "w int, x int, y int, z int")
    assert select_positions(wide, [1, 2]).columns == ["w", "x"]
    assert drop_positions(wide, [1, 2]).columns == ["y", "z"]


def test_types_are_guessed_from_all_rows(spark):
    n = 3000
    last = F.col("id") == n - 1
    text = lambda x: F.col("id").cast("string") if x is None else x
    df = spark.range(0, n, 1, 7).select(
        "id",
        text(None).alias("whole"),
        F.when(last, "1.5").otherwise(text(None)).alias("real"),
        F.when(last, "x").otherwise(text(None)).alias("late_text"),
        F.when(last, "9223372036854775808").otherwise(text(None)).alias("too_long"),
        F.when(last, "007").otherwise(text(None)).alias("code"),
        F.when(last, F.lit(None)).otherwise("T").alias("flag"),
        F.lit("2020-02-29").alias("day"),
        F.when(last, "2020-02-28 10:11:12.5").otherwise("2020-02-29").alias("moment"),
        F.when(last, "2021-02-29").otherwise("2020-02-29").alias("no_day"),
        F.when(last, "true").otherwise("1").alias("mixed"),
        F.lit(None).cast("string").alias("nothing"),
        F.when(last, "-Inf").otherwise("1e-3").alias("science"),
        F.lit("").alias("blank"),
    )
    types = sources.guess_types(df)
    assert types == {
        "whole": "bigint", "real": "double", "late_text": "string", "too_long": "double", "code": "string", "flag": "boolean", "day": "date",
        "moment": "timestamp_ntz", "no_day": "string", "mixed": "string", "nothing": "string", "science": "double", "blank": "string",
    }
    out = sources.typed(df, types)
    assert {f.name: f.dataType.simpleString() for f in out.schema.fields if f.name != "id"} == types
    assert out.agg(F.sum("whole"), F.count("flag"), F.min("science")).first()[:] == (n * (n - 1) // 2, n - 1, float("-inf"))


def test_guessing_reads_files_and_odd_tables(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "a", None, 2.5), (2, None, None, None)], "k int, s string, e string, v double")
    sources.write_tsv(df, tmpdir_path + "/t")
    out = sources.read_tsv(spark, tmpdir_path + "/t", guess=True)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["bigint", "string", "string", "double"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    sources.write_csv(df, tmpdir_path + "/c")
    assert sources.read_csv(spark, tmpdir_path + "/c", guess=True).schema == out.schema
    assert sources.guess_types(df.limit(0)) == {"s": "string", "e": "string"} and sources.guess_types(df.select("k")) == {}
    assert sources.guess_types(df, ["s", "k"]) == {"s": "string"}


def test_tsv_cells_that_begin_with_a_comment_character_are_written_plain(spark, tmpdir_path):
    df = spark.createDataFrame([("# x", "#"), ("y", "z # w")], "a string, b string")
    sources.write_tsv(df, tmpdir_path + "/t")
    assert "\x00" not in "".join(r[0] for r in spark.read.text(tmpdir_path + "/t").collect())
    assert sorted(map(tuple, sources.read_tsv(spark, tmpdir_path + "/t").collect())) == [("# x", "#"), ("y", "z # w")]
