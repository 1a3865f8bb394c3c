import os

from metaweave.operators import all_null_columns, clean_catalog, clean_frame, replace_sentinels
from metaweave.sources import read_tsv
from tests.conftest import rows


def _sentinels(spark):
    # sentinels fixture: both sentinels, a lower-case look-alike, a containing value, null,
    # an all-sentinel column and a numeric column
    data = [("Not Reported", "'--", 1, "x"), ("not reported", "Not Reported", 2, "has Not Reported inside"),
            (None, "'--", 3, "'--"), ("ok", "Not Reported", None, "y")]
    return spark.createDataFrame(data, "a string, allsent string, n int, b string")


def test_replace_is_whole_cell_and_case_sensitive(spark):
    out = replace_sentinels(_sentinels(spark))
    assert rows(out, "a") == [(None,), (None,), ("not reported",), ("ok",)]
    assert ("has Not Reported inside",) in rows(out, "b")
    assert rows(out, "n") == [(None,), (1,), (2,), (3,)]


def test_clean_frame_drops_all_null_columns_and_is_idempotent(spark):
    once, dropped = clean_frame(_sentinels(spark))
    assert dropped == ["allsent"]
    assert once.columns == ["a", "n", "b"]
    twice, dropped2 = clean_frame(once)
    assert dropped2 == [] and rows(twice) == rows(once)


def test_empty_frame_drops_every_column(spark):
    empty = spark.createDataFrame([], "a string, b int")
    out, dropped = clean_frame(empty)
    assert dropped == ["a", "b"] and out.columns == []


def test_header_only_file(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "family_history.tsv")
    with open(path, "w") as fh:
        fh.write("case_id\tcase_submitter_id\tproject_id\n")
    df = read_tsv(spark, path)
    assert df.columns == ["case_id", "case_submitter_id", "project_id"]
    assert all_null_columns(df) == df.columns


def test_clean_catalog(spark):
    cat = {"t1": _sentinels(spark), "t2": spark.createDataFrame([("'--",)], "only string")}
    cleaned, dropped = clean_catalog(cat)
    assert dropped == {"t1": ["allsent"], "t2": ["only"]}
    assert cleaned["t2"].columns == []
