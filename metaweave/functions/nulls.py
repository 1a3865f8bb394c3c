"""Null-aware column expressions.

Spark's SQL NULL differs from the missing value of data-frame languages in a few
places that decide results. Each helper here states which rule it follows:

* ``if_else``: a NULL condition gives NULL (not the ``else`` branch).
* ``case_when``: a NULL condition counts as false; no match gives NULL.
* ``recode``: unmatched values pass through; a value mapped to ``None`` becomes NULL.
* ``concat_na``: optionally renders NULL as the text ``NA`` instead of nulling the result.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit(v: Any) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def typed_null(data_type: DataType | str = StringType()) -> Column:
    """A NULL literal of a concrete type (writers reject untyped NULL columns)."""
    return F.lit(None).cast(data_type)


def if_else(condition: Column, yes: Any, no: Any) -> Column:
    """Three-valued ``if``: true -> ``yes``, false -> ``no``, NULL -> NULL."""
    cond = _col(condition)
    return F.when(cond.isNull(), F.lit(None)).when(cond, _lit(yes)).otherwise(_lit(no))


def case_when(*branches: tuple[Column, Any], default: Any = None) -> Column:
    """Ordered ``(condition, value)`` branches; a NULL condition never matches.

    Without ``default`` a row that matches no branch is NULL.
    """
    if not branches:
        raise ValueError("case_when needs at least one branch")
    expr = None
    for cond, value in branches:
        expr = F.when(_col(cond), _lit(value)) if expr is None else expr.when(_col(cond), _lit(value))
    return expr if default is None else expr.otherwise(_lit(default))


#: Default of :func:`recode`: unmatched values pass through.
PASSTHROUGH = object()


def recode(
    column: str | Column,
    mapping: Mapping[Any, Any] | Sequence[tuple[Any, Any]],
    default: Any = PASSTHROUGH,
    duplicate_key: str = "error",
) -> Column:
    """Map values; unmatched values pass through (or take ``default``).

    A key mapped to ``None`` produces NULL, and NULL input stays NULL. ``mapping``
    may be a list of pairs; a repeated key raises unless ``duplicate_key`` is
    ``'first'`` or ``'last'`` (which pair wins). Where the new values are text, values that pass
    through are cast to text, so a number may be recoded to words.
    """
    pairs = list(mapping.items()) if isinstance(mapping, Mapping) else list(mapping)
    seen: dict[Any, Any] = {}
    order: list[Any] = []
    for key, value in pairs:
        if key in seen:
            if duplicate_key == "error":
                raise ValueError(f"recode: key {key!r} is mapped twice")
            if duplicate_key == "last":
                seen[key] = value
            continue
        seen[key] = value
        order.append(key)
    if not order:
        raise ValueError("recode needs at least one pair")
    src = _col(column)
    expr = None
    for key in order:
        value = seen[key]
        out = F.lit(None) if value is None else _lit(value)
        expr = F.when(src == F.lit(key), out) if expr is None else expr.when(src == F.lit(key), out)
    if default is PASSTHROUGH:
        text = any(isinstance(seen[key], str) for key in order)
        return expr.otherwise(src.cast(StringType()) if text else src)
    return expr.otherwise(_lit(default))


def concat_na(*parts: str | Column, na_text: str | None = None) -> Column:
    """Concatenate; with ``na_text`` a NULL part is rendered as that text."""
    cols = [_col(p) if not isinstance(p, Column) else p for p in parts]
    if na_text is None:
        return F.concat(*cols)
    return F.concat(*[F.coalesce(c.cast("string"), F.lit(na_text)) for c in cols])


def coalesce_ids(preferred: str | Column, fallback: str | Column) -> Column:
    """``if_else(is.na(a), b, a)`` written as what it is."""
    return F.coalesce(_col(preferred), _col(fallback))


def all_null(columns: Iterable[str | Column]) -> Column:
    """True when every listed column is NULL in the row."""
    cols = [_col(c).isNull() for c in columns]
    if not cols:
        return F.lit(True)
    return reduce(lambda a, b: a & b, cols)


def is_in_values(column: str | Column, values: Sequence[Any]) -> Column:
    """Membership in a short literal list that is never NULL.

    ``NULL`` is in the list only if ``None`` is one of the values. Meant for a
    handful of literals; id sets that grow with data are joined instead
    (``operators.joins.restrict_to``/``flag_membership``).
    """
    src = _col(column)
    non_null = [v for v in values if v is not None]
    hit = F.coalesce(src.isin(non_null), F.lit(False)) if non_null else F.lit(False)
    if any(v is None for v in values):
        hit = hit | src.isNull()
    return hit
