"""Map a source table onto a data dictionary: rename, select, recode."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame

from metaweave.functions.nulls import recode
from metaweave.operators.schema import c, rename


def recode_columns(df: DataFrame, recodes: Mapping[str, Mapping[Any, Any] | Sequence[tuple[Any, Any]]],
                   duplicate_key: str = "error") -> DataFrame:
    """``{column: {from: to}}``: recode each listed column in place (pass-through, mapped NULL stays NULL)."""
    missing = [k for k in recodes if k not in df.columns]
    if missing:
        raise KeyError(f"recode_columns: no such columns {missing}")
    return df.withColumns({col: recode(c(col), m, duplicate_key=duplicate_key) for col, m in recodes.items()})


def apply_dictionary(df: DataFrame, renames: Mapping[str, str] | None = None, keep: Sequence[str] | None = None,
                     recodes: Mapping[str, Mapping[Any, Any] | Sequence[tuple[Any, Any]]] | None = None,
                     duplicate_key: str = "error") -> DataFrame:
    """Rename ``{old: new}``, keep the dictionary's columns in order, then recode values."""
    out = rename(df, renames) if renames else df
    if keep is not None:
        out = out.select(*[c(x) for x in keep])
    return recode_columns(out, recodes, duplicate_key) if recodes else out
