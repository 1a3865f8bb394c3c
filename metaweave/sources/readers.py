"""Readers with one missing-value policy.

Policy: the literal text ``NA`` and blank cells are NULL on every reader; columns
are read as strings unless a schema is given or ``guess`` asks for types by all rows (:mod:`.types`),
and typed later with ``try_cast`` (ANSI mode raises on a bad ``cast``). Each file of a catalogue gets its own reader
because the files have different schemas.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from metaweave.sources.types import guess_types, typed

NA_TEXT = "NA"


def _delimited(spark: SparkSession, path: str, sep: str, schema: StructType | str | None, comment: str | None,
               header: bool = True, **options: Any) -> DataFrame:
    reader = (
        spark.read.option("header", str(header).lower())
        .option("sep", sep)
        .option("nullValue", NA_TEXT)
        .option("emptyValue", NA_TEXT)  # a quoted blank cell is NULL too, and a blank name is _c0
        .option("mode", "PERMISSIVE")
        .option("multiLine", "false")
    )
    if comment:
        reader = reader.option("comment", comment)
    for k, v in options.items():
        reader = reader.option(k, v)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def _guessed(df: DataFrame, guess: bool) -> DataFrame:
    return typed(df, guess_types(df)) if guess else df


def read_tsv(spark: SparkSession, path: str, schema: StructType | str | None = None, guess: bool = False, **options: Any) -> DataFrame:
    """Tab-separated file with a header (strings unless ``schema`` is given, or types guessed from all rows)."""
    return _guessed(_delimited(spark, path, "\t", schema, None, **options), guess)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, sanitize: bool = False,
             drop_index: bool = False, guess: bool = False, **options: Any) -> DataFrame:
    """Comma-separated file with a header.

    ``sanitize`` turns ``A.B`` names into ``A_B``; ``drop_index`` removes the leading
    row-number column of a file written with an index (its blank header reads as ``_c0``). ``guess`` settles
    the types by all rows, in a pass of its own.
    """
    df = _delimited(spark, path, ",", schema, None, **options)
    if drop_index and df.columns and df.columns[0] in ("_c0", ""):
        df = df.drop(df.columns[0])
    return _guessed(sanitize_names(df) if sanitize else df, guess)


def read_commented_tsv(spark: SparkSession, path: str, comment: str = "#") -> DataFrame:
    """TSV with a header, without what follows a comment character, in the header too; blank lines are left out.

    One small job reads the header; repeated headers (one per part file) are dropped. Columns are strings.
    """
    cut = F.regexp_replace("value", re.escape(comment) + ".*$", "")
    lines = spark.read.text(path).select(F.regexp_replace(cut, "[ ]+$", "").alias("line")).filter(F.trim("line") != "")
    first = lines.first()
    names = first["line"].split("\t") if first else []
    fields = F.split("line", "\t")
    cells = [F.get(fields, F.lit(i)) for i in range(len(names))]
    cols = [F.when((x != NA_TEXT) & (F.trim(x) != ""), F.trim(x)).alias(n.strip()) for x, n in zip(cells, names)]
    return lines.filter(F.col("line") != first["line"]).select(*cols) if first else lines.select()


def read_json_array(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A file holding one JSON array of flat objects -> one flat table.

    ``multiLine`` files are one task each; :func:`.json_ranges.read_json_array_ranges` reads large ones by byte ranges.
    """
    reader = spark.read.option("multiLine", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON lines (splittable)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """Reload a table written by ``writers.save_tables``."""
    return spark.read.parquet(path)


def list_table_files(spark: SparkSession, folder: str, suffix: str = ".tsv") -> dict[str, str]:
    """``{stem: path}`` for the files, or folders of part files, of a folder (stem = name without the first ``suffix``).

    Spark lists the folder, so any file system that it reads will do; only names come to the driver.
    """
    root = folder.rstrip("/")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    below = F.substring_index(F.col("path"), root.rsplit("/", 1)[-1] + "/", -1)
    names = sorted(r[0] for r in found.select(F.split_part(below, F.lit("/"), F.lit(1))).distinct().collect())
    return {name.replace(suffix, "", 1): f"{root}/{name}" for name in names if suffix in name}


def read_catalog(spark: SparkSession, source: str | Mapping[str, str], suffix: str = ".tsv", sep: str = "\t") -> dict[str, DataFrame]:
    """Load a folder (or ``{name: path}``) of delimited files as ``{stem: DataFrame}``, one reader per file."""
    paths = source if isinstance(source, Mapping) else list_table_files(spark, source, suffix)
    return {stem: _delimited(spark, path, sep, None, None) for stem, path in paths.items()}


def id_table(spark: SparkSession, ids: Iterable[Any], name: str = "id", data_type: str = "string") -> DataFrame:
    """A one-column table from a literal id list (the list is bounded by the code that holds it)."""
    return spark.createDataFrame([(v,) for v in ids], f"`{name}` {data_type}")


def null_scaffold(ids: DataFrame, template: Sequence[tuple[str, DataType | str]], id_column: str | None = None,
                  fill: dict[str, Any] | None = None) -> DataFrame:
    """One row per row of ``ids`` with every template column a typed NULL.

    ``id_column`` names the template column that receives the id; ``fill`` sets
    constant columns.
    """
    fill = fill or {}
    src = ids.columns[0]
    cols = []
    for name, dtype in template:
        if name == id_column:
            cols.append(F.col(src).cast(dtype).alias(name))
        elif name in fill:
            cols.append(F.lit(fill[name]).cast(dtype).alias(name))
        else:
            cols.append(F.lit(None).cast(dtype).alias(name))
    return ids.select(*cols)


_BAD_NAME = re.compile(r"[^0-9A-Za-z_]")


def sanitize_names(df: DataFrame) -> DataFrame:
    """Replace characters other than letters, digits and ``_`` in column names by ``_``."""
    new = [_BAD_NAME.sub("_", c) for c in df.columns]
    if len(set(new)) != len(new):
        raise ValueError(f"sanitize_names: names collide after cleaning: {new}")
    return df.toDF(*new)


def as_schema(template: Sequence[tuple[str, DataType | str]]) -> StructType:
    """``[(name, type)]`` -> ``StructType`` (string types parsed by Spark)."""
    fields = []
    for name, dtype in template:
        if isinstance(dtype, str):
            dtype = StructType.fromDDL(f"x {dtype}").fields[0].dataType
        fields.append(StructField(name, dtype, True))
    return StructType(fields)
