"""Output templates with rules: types, required fields, allowed values and patterns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType, IntegralType

from metaweave.operators.schema import c
from metaweave.session import materialize


@dataclass(frozen=True)
class TemplateField:
    """One column of a template; rules are tested on the value as it comes in, read as text.

    ``required`` forbids NULL, ``allowed`` lists the only values, and ``pattern`` is a Java regex that the whole value
    must match. ``allowed`` and ``pattern`` let NULL pass.
    """

    name: str
    type: str = "string"
    required: bool = False
    allowed: Sequence[str] | None = None
    pattern: str | None = None


class CheckedRows(NamedTuple):
    """``conforming`` rows in the template's types, ``rejected`` rows as they came, and one row per broken rule."""

    conforming: DataFrame
    rejected: DataFrame
    problems: DataFrame


def _broken(df: DataFrame, field: TemplateField) -> list[tuple[str, Column]]:
    """``(rule, whether it is broken)`` of one field; never NULL."""
    if field.name not in df.columns:
        return [("required", F.lit(True))] if field.required else []
    value, kind = c(field.name), df.schema[field.name].dataType
    text, given = value.cast("string"), value.isNotNull()
    rules = [("required", ~given)] if field.required else []
    if kind.simpleString() != field.type:
        fits = value.try_cast(field.type)
        bad = fits.isNull()
        if isinstance(kind, FractionalType) and isinstance(df.select(F.lit(None).cast(field.type)).schema[0].dataType, IntegralType):
            bad = bad | (fits != value)  # a cast would cut off the fraction
        rules.append(("type", given & bad))
    if field.allowed is not None:
        rules.append(("allowed", given & ~text.isin(*field.allowed) if field.allowed else given))
    if field.pattern is not None:
        rules.append(("pattern", given & ~F.regexp_like(text, F.lit(rf"^(?:{field.pattern})\z"))))
    return rules


def check_template(df: DataFrame, fields: Sequence[TemplateField], key: Sequence[str]) -> CheckedRows:
    """Fit ``df`` to a template and say which cells do not fit.

    A row conforms if no rule of any field is broken; every input row is either in ``conforming`` or in ``rejected``.
    ``conforming`` has the template's columns in order and type, those that ``df`` lacks as NULL, and drops all others.
    ``rejected`` has the columns of ``df`` unchanged. ``problems`` has the ``key`` columns, ``column``, ``value`` (text,
    NULL for a missing one) and ``rule``: ``required``, ``type`` (the value cannot be cast, or would lose its
    fraction), ``allowed`` or ``pattern``; a cell can break several. Rows that repeat report each time.

    The rules are one expression per row; rows and their broken rules are written once to the shared folder, and the three
    results are read from there, so the input is evaluated once and nothing is shuffled.
    """
    names = [f.name for f in fields]
    if len({x.lower() for x in names}) != len(names):
        raise ValueError(f"check_template: a field is listed twice: {names}")
    clash = {x.lower() for x in key} & {"column", "value", "rule"}
    if clash:
        raise ValueError(f"check_template: key columns named like the report's own: {sorted(clash)}")
    kind = "array<struct<column:string,value:string,rule:string>>"
    entries = []
    for f in fields:
        value = c(f.name).cast("string") if f.name in df.columns else F.lit(None).cast("string")
        for rule, bad in _broken(df, f):
            found = F.struct(F.lit(f.name).alias("column"), value.alias("value"), F.lit(rule).alias("rule"))
            entries.append(F.when(bad, found))
    problems = F.filter(F.array(*entries), lambda e: e.isNotNull()) if entries else F.array()
    own = [f"c{i}" for i in range(len(df.columns))]  # names that clash with nothing
    given = df.select(*[c(x).alias(o) for x, o in zip(df.columns, own)], problems.cast(kind).alias("problems"))
    held = materialize(given)
    at = dict(zip(df.columns, own))
    back = [F.col(o).alias(x) for x, o in at.items()]
    fitted = [
        (F.col(at[f.name]).try_cast(f.type) if f.name in at else F.lit(None).cast(f.type)).alias(f.name) for f in fields
    ]
    bad = F.size("problems") > 0
    return CheckedRows(
        held.where(~bad).select(*fitted),
        held.where(bad).select(*back),
        held.where(bad).select(*[F.col(at[x]).alias(x) for x in key], F.inline("problems")),
    )
