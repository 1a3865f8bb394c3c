"""Long-to-wide pivots and keep-first de-duplication.

Both reduce each key inside every map task before the shuffle (partial
aggregation for pivots, a partial group limit for keep-first), so a key that
holds a large share of the rows is not moved whole to one task. No window over
the whole (unpartitioned) frame is used.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metaweave.operators.schema import c


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the row that sorts first by ``order_by`` (ascending, NULLs first).

    The remaining columns are appended to the ordering, so the choice is total and
    does not depend on row order or partitioning. Written as ``row_number() == 1``
    over a window partitioned by ``keys``; Spark plans it with a partial
    per-partition group limit *before* the shuffle, so every map task sends at most
    one row per key and a key holding a large share of the rows stays cheap.
    """
    keys = list(keys)
    order = list(order_by) + [x for x in df.columns if x not in keys and x not in order_by]
    if not order:
        return df.select(*[c(k) for k in keys]).distinct()
    w = Window.partitionBy(*[c(k) for k in keys]).orderBy(*[c(x).asc_nulls_first() for x in order])
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def pivot_wider(
    df: DataFrame,
    names_from: str,
    values_from: str | Sequence[str],
    values: Sequence[Any] | None = None,
    id_cols: Sequence[str] | None = None,
    fill: Any = None,
    on_duplicate: str = "error",
    names_sep: str = "_",
    unlisted: str = "error",
    max_names: int = 10_000,
    sort_names: bool = True,
) -> DataFrame:
    """``pivot_wider``: one row per ``id_cols`` (default: every other column), in one aggregation.

    New columns follow the sorted order of ``values``, or the given one without ``sort_names`` (names in the order of their
    first appearance: ``position.first_appearance``); without ``values`` one extra job finds the names (at
    most ``max_names``, else an error; a schema cannot grow with the data). A NULL name becomes the column ``NA``, the last
    one if names are sorted. With several ``values_from`` the names are ``{value_column}{names_sep}{key}``.

    The action raises for a name that is not listed, unless ``unlisted='drop'``, and for a cell with
    several rows under ``on_duplicate='error'``. ``'first'`` keeps one whole row of the cell, the one with the
    smallest values (NULLs last); ``'list'`` keeps all as sorted arrays, NULLs first. ``fill`` goes to cells
    without any row; a cell whose value is NULL stays NULL.
    """
    if on_duplicate not in ("error", "first", "list") or unlisted not in ("error", "drop"):
        raise ValueError(f"pivot_wider: unknown policy {on_duplicate!r} or {unlisted!r}")
    vcols = [values_from] if isinstance(values_from, str) else list(values_from)
    ids = list(id_cols) if id_cols is not None else [x for x in df.columns if x != names_from and x not in vcols]
    if values is None:
        found = df.select(c(names_from)).distinct().limit(max_names + 1).collect()
        if len(found) > max_names:
            raise ValueError(f"pivot_wider: more than {max_names} distinct values in {names_from!r}; pass `values`")
        values = [r[0] for r in found]
    elif unlisted == "error":
        listed = [v for v in values if v is not None]
        known = F.coalesce(c(names_from).isin(listed), F.lit(False)) if listed else F.lit(False)
        if any(v is None for v in values):
            known = known | c(names_from).isNull()
        message = F.concat(F.lit(f"pivot_wider: a name of {names_from} is not listed: "), F.coalesce(c(names_from).cast("string"), F.lit("NULL")))
        df = df.withColumn(names_from, F.when(known, c(names_from)).otherwise(F.raise_error(message)))
    if sort_names:
        values = sorted(v for v in values if v is not None) + ([None] if any(v is None for v in values) else [])
    else:
        values = list(dict.fromkeys(values))
    row = F.struct(*[c(v).alias(f"v{i}") for i, v in enumerate(vcols)])
    if on_duplicate == "list":
        value = F.collect_list(row)
    else:
        value = F.min_by(row, F.struct(*[x for v in vcols for x in (c(v).isNull(), c(v))]))
    wide = df.groupBy(*[c(x) for x in ids]).pivot(names_from, values).agg(F.count(F.lit(1)).alias("n"), value.alias("v"))
    wide = wide.toDF(*[f"id{i}" for i in range(len(ids))], *[f"{x}{i}" for i in range(len(values)) for x in ("n", "v")])

    def cell(k: int, i: int) -> Column:
        n, v = F.col(f"n{k}"), F.col(f"v{k}")
        if on_duplicate == "list":
            out = F.when(n > 0, F.array_sort(F.transform(v, lambda x: x[f"v{i}"]), _nulls_first))
        else:
            out = v[f"v{i}"]
        if on_duplicate == "error":
            message = "pivot_wider: some cells have more than one row (use on_duplicate='first' or 'list')"
            out = F.when(n > 1, F.raise_error(F.lit(message))).otherwise(out)
        return out if fill is None else F.when(F.coalesce(n, F.lit(0)) > 0, out).otherwise(F.lit(fill))

    def name(vcol: str, v: Any) -> str:
        key = "NA" if v is None else str(v)
        return key if len(vcols) == 1 else f"{vcol}{names_sep}{key}"

    return wide.select(
        *[F.col(f"id{i}").alias(x) for i, x in enumerate(ids)],
        *[cell(k, i).alias(name(vcol, v)) for i, vcol in enumerate(vcols) for k, v in enumerate(values)],
    )


def _nulls_first(a: Column, b: Column) -> Column:
    order = F.when(a.isNull() & b.isNull(), 0).when(a.isNull(), -1).when(b.isNull(), 1)
    return order.when(a < b, -1).when(a > b, 1).otherwise(0)


def unpivot_longer(df: DataFrame, id_cols: Sequence[str], value_cols: Sequence[str],
                   names_to: str = "name", values_to: str = "value") -> DataFrame:
    """Wide to long (the inverse of ``pivot_wider``), via Spark's ``unpivot``."""
    return df.unpivot(list(id_cols), list(value_cols), names_to, values_to)
