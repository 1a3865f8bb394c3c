"""Order of the input: where each row stood, ties in prior order, names in the order of their first appearance."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaweave.operators.ids import _placed
from metaweave.operators.schema import c

PLACE = "struct<file:string,start:bigint,row:bigint>"


def with_position(df: DataFrame, name: str = "position") -> DataFrame:
    """Add the place of each row in the files that ``df`` reads: file, first byte of its block, row.

    Positions sort as the rows stand in the files (files by name), whatever blocks and partitions they are read in; their
    numbers are not row numbers. ``df`` must read files, and may have been filtered or projected, not shuffled.
    """
    at = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row")
    )
    return df.select("*", at.alias(name))


def stable_sort_index(df: DataFrame, order_by: Sequence[str], position: str = "position", name: str = "row_index") -> DataFrame:
    """Number the rows 1..N in ``order_by`` order (ascending, NULLs first), ties in the order of the input; drops ``position``."""
    placed = _placed(df, [*order_by, position])
    return placed.select(*[c(x) for x in df.columns if x != position], F.col("__at").alias(name))


def first_appearance(df: DataFrame, column: str, position: str = "position", max_names: int = 10_000) -> list[Any]:
    """The different values of ``column`` (NULL too) in the order of their first rows; at most ``max_names``, else an error."""
    found = df.groupBy(c(column).alias("value")).agg(F.min(c(position)).alias("at")).limit(max_names + 1).collect()
    if len(found) > max_names:
        raise ValueError(f"first_appearance: more than {max_names} different values in {column!r}")
    return [r["value"] for r in sorted(found, key=lambda r: tuple(r["at"]))]
