"""String expressions for positional barcodes and file paths.

All are built-in Spark functions, so they stay inside whole-stage code generation.
Positions are 1-based and inclusive like the substring functions of R and SQL.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def str_sub(column: str | Column, start: int, end: int) -> Column:
    """Characters ``start..end`` (1-based, inclusive), e.g. the case part of a barcode."""
    if start < 1 or end < start:
        raise ValueError("str_sub needs 1 <= start <= end")
    return F.substring(_col(column), start, end - start + 1)


def drop_last(column: str | Column, n: int = 1) -> Column:
    """Remove the last ``n`` characters; shorter strings are left unchanged.

    Same result as the anchored pattern ``.{n}$`` replaced by ``''``, without a regex.
    """
    src = _col(column)
    return F.when(F.length(src) >= n, F.substring(src, F.lit(1), F.length(src) - F.lit(n))).otherwise(src)


def drop_suffix_regex(column: str | Column, pattern: str) -> Column:
    """Remove an end-anchored pattern such as ``-.{3}`` (the anchor is added)."""
    return F.regexp_replace(_col(column), f"(?:{pattern})$", "")


def last_chars(column: str | Column, n: int) -> Column:
    """The last ``n`` characters, NULL when the string is shorter (no match is NULL)."""
    src = _col(column)
    return F.when(F.length(src) >= n, F.substring(src, -n, n))


def extract(column: str | Column, pattern: str) -> Column:
    """First match of ``pattern``; NULL (not ``''``) when nothing matches."""
    return F.regexp_substr(_col(column), F.lit(pattern))


def detect(column: str | Column, pattern: str) -> Column:
    """Regex search anywhere in the string."""
    return _col(column).rlike(pattern)


def sub_first(column: str | Column, pattern: str, replacement: str) -> Column:
    """Replace only the first match (Spark's ``regexp_replace`` replaces all)."""
    escaped = replacement.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(_col(column), f"(?s)^(.*?)(?:{pattern})", "$1" + escaped)


def rewrite_path(
    column: str | Column,
    prefix: str = "",
    old_suffix: str | None = None,
    new_suffix: str | None = None,
    literal: bool = True,
) -> Column:
    """Prefix a relative file name and swap its extension.

    With ``literal=True`` (default) ``old_suffix`` is matched literally and only at
    the end. ``literal=False`` treats it as an unanchored regex replaced everywhere,
    which reproduces ``gsub(".bam", ...)`` where the dot matches any character.
    """
    out = F.concat(F.lit(prefix), _col(column)) if prefix else _col(column)
    if old_suffix is None:
        return out
    if new_suffix is None:
        raise ValueError("rewrite_path: new_suffix is required with old_suffix")
    if literal:
        return F.regexp_replace(out, re.escape(old_suffix) + "$", new_suffix.replace("$", "\\$"))
    return F.regexp_replace(out, old_suffix, new_suffix.replace("$", "\\$"))
