"""Fill-in-the-middle: texts cut at two unit boundaries and written as prefix, suffix and middle.

A unit is a run of ASCII letters or any other single code point. The offsets between units, with both ends
of the text, form a :class:`~.boundary_set.BoundarySet`; the two cuts are its k-th members, found
by container search and local select. The numbers behind the cuts and the form are the first 32-bit groups of a
SHA-256 of the seed and the identifier, so a text gets the same cuts wherever and whenever it is processed.

Every row is worked on alone, in Arrow batches: no shuffle, and a lost task is repeated with the same result.

Defined results: NULL text counts as empty; empty texts, texts that hold a marker, and a fixed share of the others
are ``plain`` and pass unchanged, with NULL lengths. A NULL identifier counts as empty in the hash. Rows with the
same identifier and text give the same row each. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .boundary_set import BoundarySet

SEED = 1
PLAIN_FROM = 90  # of 100: from here on a text stays plain
SPM_BELOW = 20  # of 100: below, the suffix comes first
#: The markers of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def boundaries(text: str) -> BoundarySet:
    """The offsets, in code points, between the units of a text, and its two ends."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    lower = codes | 32
    letter = (lower >= ord("a")) & (lower <= ord("z"))
    edge = np.ones(len(codes) + 1, bool)
    edge[1:-1] = ~(letter[1:] & letter[:-1])
    return BoundarySet(np.flatnonzero(edge))


def numbers(doc_id: str | None, seed: int = SEED) -> list[int]:
    """Eight 32-bit numbers of an identifier."""
    digest = sha256(f"{seed}:{doc_id or ''}".encode()).digest()
    return np.frombuffer(digest, ">u4").tolist()


def cut(text: str, doc_id: str | None, seed: int = SEED) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, prefix length, middle length, output) of one text."""
    edges = boundaries(text)
    n = len(edges) - 1
    h1, h2, h3, h4, *_ = numbers(doc_id, seed)
    if not text or h3 % 100 >= PLAIN_FROM or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = edges.select(a), edges.select(b)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SPM_BELOW:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """One row per document: ``doc_id``, ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and the whole ``output``."""

    def batch(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for ids, texts in parts:
            rows = [cut(t or "", i, seed) for i, t in zip(ids, texts)]
            out = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
            yield out.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    made = F.pandas_udf(batch, "n long, form string, prefix_chars long, middle_chars long, output string")
    rows = docs.select(F.col(doc_id).alias("doc_id"), made(F.col(doc_id).cast("string"), F.col(text)).alias("x"))
    return rows.select("doc_id", "x.n", "x.form", "x.prefix_chars", "x.middle_chars", "x.output")


def restored(output: Column, form: Column) -> Column:
    """The exact text, from an output and its form alone.

    No marker can begin in one part and end in the next, since no marker's end is another one's beginning; and no
    part holds one. So the first marker of a kind is the real one.
    """

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        rest = F.split(F.substr(output, F.lit(len(first) + 1)), second, 2)
        tail = F.split(F.get(rest, F.lit(1)), MIDDLE, 2)
        return F.get(rest, F.lit(0)), F.get(tail, F.lit(0)), F.get(tail, F.lit(1))

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(SUFFIX, PREFIX)
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
