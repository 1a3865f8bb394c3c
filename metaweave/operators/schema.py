"""Column-level (metadata-only) operators: no Spark job runs here."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType


def c(name: str) -> Column:
    """Column by exact name (names may hold dots or dashes)."""
    return F.col("`" + name.replace("`", "``") + "`")


def select_range(df: DataFrame, first: str, last: str) -> DataFrame:
    """Columns ``first`` through ``last`` in frame order (``select(A:B)``)."""
    cols = df.columns
    i, j = cols.index(first), cols.index(last)
    if j < i:
        raise ValueError(f"select_range: {last!r} comes before {first!r}")
    return df.select(*[c(x) for x in cols[i : j + 1]])


def select_positions(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    """Columns by 1-based position."""
    cols = df.columns
    return df.select(*[c(cols[p - 1]) for p in positions])


def drop_positions(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    """All columns except the 1-based ``positions`` (``select(!1:2)``)."""
    drop = {p - 1 for p in positions}
    return df.select(*[c(x) for i, x in enumerate(df.columns) if i not in drop])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """``{old: new}``; every old name must exist."""
    missing = [k for k in mapping if k not in df.columns]
    if missing:
        raise KeyError(f"rename: no such columns {missing}")
    return df.withColumnsRenamed(dict(mapping))


def relocate(df: DataFrame, column: str, before: str | None = None, after: str | None = None) -> DataFrame:
    """Move ``column`` right before or after another column."""
    if (before is None) == (after is None):
        raise ValueError("relocate: give exactly one of before/after")
    rest = [x for x in df.columns if x != column]
    anchor = before if before is not None else after
    pos = rest.index(anchor) + (0 if before is not None else 1)
    order = rest[:pos] + [column] + rest[pos:]
    return df.select(*[c(x) for x in order])


def prefix_names(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[prefix + x for x in df.columns])


def lower_names(df: DataFrame) -> DataFrame:
    new = [x.lower() for x in df.columns]
    if len(set(new)) != len(new):
        raise ValueError(f"lower_names: names collide: {df.columns}")
    return df.toDF(*new)


def add_constants(df: DataFrame, values: Mapping[str, tuple[Any, DataType | str]]) -> DataFrame:
    """Add or overwrite columns with typed constants (``None`` -> typed NULL)."""
    return df.withColumns({name: F.lit(v).cast(t) for name, (v, t) in values.items()})


def apply_by_type(df: DataFrame, predicate: Callable[[DataType], bool],
                  fn: Callable[[Column], Column]) -> DataFrame:
    """``mutate(across(where(pred), fn))``: apply ``fn`` to every column whose type matches."""
    targets = {f.name: fn(c(f.name)).alias(f.name) for f in df.schema.fields if predicate(f.dataType)}
    return df.withColumns(targets) if targets else df


def catalog_columns(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table, position, column, type)`` for every table of a catalogue (schema only)."""
    rows = [
        (name, i + 1, f.name, f.dataType.simpleString())
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(rows, "table string, position int, column string, type string")


def conform(df: DataFrame, template: Sequence[tuple[str, DataType | str]] | StructType,
            extra: str = "drop") -> DataFrame:
    """Fit ``df`` to an output template: add missing columns as typed NULLs, order, cast.

    Casts use ``try_cast`` so a bad value becomes NULL instead of failing the job.
    ``extra='keep'`` appends columns that are not in the template; ``'error'`` raises.
    """
    fields = [(f.name, f.dataType) for f in template.fields] if isinstance(template, StructType) else list(template)
    names = [n for n, _ in fields]
    leftover = [x for x in df.columns if x not in names]
    if leftover and extra == "error":
        raise ValueError(f"conform: columns outside the template: {leftover}")
    cols = []
    for name, dtype in fields:
        tname = dtype if isinstance(dtype, str) else dtype.simpleString()
        if name in df.columns:
            cols.append(c(name).try_cast(tname).alias(name) if _type_of(df, name) != tname else c(name))
        else:
            cols.append(F.lit(None).cast(tname).alias(name))
    if extra == "keep":
        cols += [c(x) for x in leftover]
    return df.select(*cols)


def _type_of(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()
