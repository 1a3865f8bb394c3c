"""Missing-value cleaning: sentinel text to NULL, then drop columns that hold only NULL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from metaweave.operators.schema import c

# The whole-cell, case-sensitive texts that mean "missing" in the
# portal exports the toolkit was built for.
DEFAULT_SENTINELS = ("Not Reported", "'--")


def replace_sentinels(df: DataFrame, sentinels: Sequence[str] = DEFAULT_SENTINELS) -> DataFrame:
    """Whole-cell match of ``sentinels`` in string columns becomes NULL (other types untouched)."""
    values = list(sentinels)
    if not values:
        return df
    repl = {
        f.name: F.when(c(f.name).isin(values), F.lit(None).cast(StringType())).otherwise(c(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, StringType)
    }
    return df.withColumns(repl) if repl else df


def all_null_columns(df: DataFrame) -> list[str]:
    """Names of columns with no non-NULL value (every column of an empty frame).

    One aggregation job: a ``count`` per column, partial-aggregated per task, so
    the driver receives a single row whatever the size of the data.
    """
    if not df.columns:
        return []
    aliases = [f"_n{i}" for i in range(len(df.columns))]
    row = df.agg(*[F.count(c(name)).alias(a) for name, a in zip(df.columns, aliases)]).first()
    return [name for name, a in zip(df.columns, aliases) if row[a] == 0]


def drop_all_null_columns(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``select(where(~!all(is.na(.))))`` -> ``(frame, dropped names)``."""
    dropped = all_null_columns(df)
    keep = [x for x in df.columns if x not in set(dropped)]
    return df.select(*[c(x) for x in keep]), dropped


def clean_frame(df: DataFrame, sentinels: Sequence[str] = DEFAULT_SENTINELS) -> tuple[DataFrame, list[str]]:
    """Sentinels -> NULL, then drop all-NULL columns. Running it twice equals running it once."""
    return drop_all_null_columns(replace_sentinels(df, sentinels))


def clean_catalog(tables: Mapping[str, DataFrame],
                  sentinels: Sequence[str] = DEFAULT_SENTINELS) -> tuple[dict[str, DataFrame], dict[str, list[str]]]:
    """``clean_frame`` over every table of a catalogue."""
    cleaned, dropped = {}, {}
    for name, df in tables.items():
        cleaned[name], dropped[name] = clean_frame(df, sentinels)
    return cleaned, dropped
