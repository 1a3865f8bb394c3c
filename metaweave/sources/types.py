"""Column types guessed from all rows of text columns.

The types form a lattice: ``bigint`` below ``double``, ``date`` below ``timestamp_ntz``, and text above all. What a column's
values allow is one flag for each type, and flags of different parts of a table merge by ``and``, so one
aggregation over all rows settles every column; nothing is sampled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from metaweave.operators.schema import c

#: From the narrowest to the widest; a value of a type is a value of the wider type of its kind too.
_RULES: list[tuple[str, str]] = [
    ("boolean", r"^(TRUE|FALSE|True|False|true|false|T|F)$"),
    ("bigint", r"^-?(0|[1-9][0-9]{0,18})$"),  # digits behind a leading zero are an identifier
    ("double", r"^-?((0|[1-9][0-9]*)(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$|^NaN$|^-?Inf(inity)?$"),
    ("date", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
    ("timestamp_ntz", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?$"),
]


def _fits(value: Column, kind: str, shape: str) -> Column:
    """Whether a text is written as a value of the type and is one (the 31st of June is no date); NULL for NULL."""
    return F.when(value.isNotNull(), F.regexp_like(value, F.lit(shape)) & value.try_cast(kind).isNotNull())


def guess_types(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, str]:
    """``{column: type}`` for the text columns of ``df`` (or those named): the narrowest type that all values have.

    NULL fits every type; a column without any value stays text, and so does one of an empty table. One job with
    partial aggregation; one row of flags comes to the driver.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    names = [x for x in (columns if columns is not None else text) if x in text]
    if not names:
        return {}
    flags = [F.bool_and(_fits(c(x), kind, shape)).alias(f"{i}_{j}") for i, x in enumerate(names) for j, (kind, shape) in enumerate(_RULES)]
    row = df.agg(*flags).first()
    return {x: next((kind for j, (kind, _) in enumerate(_RULES) if row[f"{i}_{j}"]), "string") for i, x in enumerate(names)}


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """``df`` with the named text columns cast; a value that is not of the type raises."""
    return df.withColumns({x: c(x).cast(kind) for x, kind in types.items() if kind != "string"})
