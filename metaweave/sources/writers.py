"""Writers for flat manifests and table checkpoints.

Spark writes a folder of part files. Every writer uses ``mode('overwrite')`` on
the final frame once; never read and overwrite the same path in one job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NullType

from metaweave.sources.readers import NA_TEXT


def _typed(df: DataFrame) -> DataFrame:
    """Cast untyped NULL columns to string: the CSV writer rejects ``void``."""
    fixes = {f.name: F.col(f"`{f.name}`").cast("string") for f in df.schema.fields if isinstance(f.dataType, NullType)}
    return df.withColumns(fixes) if fixes else df


def write_csv(df: DataFrame, path: str, quote_all: bool = True, single_file: bool = False) -> None:
    """Quoted CSV with a header and ``NA`` for NULL.

    ``single_file`` writes through one task, for tables that one machine can hold.
    """
    out = _typed(df)
    if single_file:
        out = out.coalesce(1)
    (
        out.write.mode("overwrite")
        .option("header", "true")
        .option("nullValue", NA_TEXT)
        .option("quoteAll", str(quote_all).lower())
        .option("escape", '"')
        .csv(path)
    )


def write_csv_indexed(df: DataFrame, path: str, order_by: Sequence[str], index_name: str = "") -> None:
    """CSV with a leading 1..N row-number column (header ``index_name``, blank by default)."""
    from metaweave.operators.ids import with_row_index

    indexed = with_row_index(df, order_by, name="__row_index")
    write_csv(indexed.select("__row_index", *[F.col(f"`{c}`") for c in df.columns]).toDF(index_name, *df.columns), path)


def write_tsv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Unquoted TSV with a header; NULL is written as bare ``NA``."""
    out = _typed(df)
    if single_file:
        out = out.coalesce(1)
    (
        out.write.mode("overwrite")
        .option("header", "true")
        .option("sep", "\t")
        .option("nullValue", NA_TEXT)
        .option("quote", "")
        .option("comment", "\u0001")  # else the writer sets apart cells that begin with its own comment character, #
        .csv(path)
    )


def save_tables(tables: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """Checkpoint several tables, one Parquet folder each; returns ``{name: path}``."""
    paths = {}
    for name, df in tables.items():
        path = f"{folder.rstrip('/')}/{name}"
        _typed(df).write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths
