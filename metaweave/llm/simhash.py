"""Near duplicates by SimHash fingerprints with multi-index hashing.

The 64 bits are cut into segments. Two fingerprints at most ``k`` bits apart agree in
some segment up to ``k // segments`` bits (the first ``k % segments + 1`` segments) or
one bit less (the others), so it is enough to enumerate these small balls around each
segment value, fetch the table entries of that segment, and verify the whole distance.
Fingerprints are made unique first; a group of exact copies is one entry.

Within a bucket every entry is first compared with the bucket's smallest entry. Two
entries that this links to the same one need not be paired again, so a dense group
adds links in proportion to its size. No link between different components is
lost, and the components are those of the full link graph.

Defined results: NULL and texts without words have fingerprint zero and are linked like any
other. Texts of fewer words than a shingle are one shingle. Repeated rows share their
component. ``component_id`` is the smallest identifier of the component that is not NULL. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved
from .components import components

BITS = 64
SHINGLE = 4
MAX_BITS = 4
SEGMENTS = 3
SEED = 42
_CHUNK = 1 << 16


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text: a bit is set if more than half of the shingle hashes have it."""
    w = (text or "").encode().lower().split()  # bytes: ASCII white space and A to Z only
    if not w:
        return 0
    joined = b" ".join(w)
    if len(w) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, w), np.int64, len(w)) + 1
        ends = np.cumsum(lengths) - 1
        starts = ends - lengths + 1
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist())]
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), _CHUNK):
        part = np.array(hashes[i : i + _CHUNK], "<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits((2 * ones > len(hashes)).astype(np.uint8), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """Fingerprints as signed longs, computed in Arrow batches."""

    def batch(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash(t, shingle) for t in texts], np.uint64).view(np.int64))

    return F.pandas_udf(batch, "long")(text)


def _layout(segments: int, k: int) -> list[tuple[int, int, int]]:
    """(first bit, width, radius) of each segment."""
    base, extra = divmod(k, segments)
    out, at = [], 0
    for i in range(segments):
        width = BITS // segments + (i >= segments - BITS % segments)
        out.append((at, width, base if i <= extra else base - 1))
        at += width
    return out


def _keys(fp: Column, segments: int, k: int, balls: bool) -> Column:
    """The table keys of a fingerprint (segment number over its value), or those of the balls around it."""
    keys = []
    for i, (at, width, radius) in enumerate(_layout(segments, k)):
        value = F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << width) - 1))
        flips = [sum(1 << b for b in c) for r in range((radius if balls else 0) + 1) for c in combinations(range(width), r)]
        if not balls:
            flips = [0]
        elif radius < 0:
            flips = []
        keys += [value.bitwiseXOR(F.lit((i << 48) | f)) for f in flips]
    return F.array(*keys)


def links(prints: DataFrame, k: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """Links ``a``, ``b`` between unique fingerprints ``fp``: enough of them to connect every component."""
    near = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= k
    index = prints.select("fp", F.explode(_keys(F.col("fp"), segments, k, balls=False)).alias("key"))
    hubs = index.groupBy("key").agg(F.min("fp").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    stars = index.join(hubs, "key").where((F.col("hub") < F.col("fp")) & near("fp", "hub"))
    stars = saved(stars.groupBy("fp").agg(F.collect_set("hub").alias("hubs")), "stars")

    marked = prints.select("fp").join(stars.select("fp", F.array_min("hubs").alias("star")), "fp", "left")
    marked = saved(marked.select("fp", F.coalesce("star", "fp").alias("star")), "marked")
    entries = marked.select("fp", "star", F.explode(_keys(F.col("fp"), segments, k, balls=False)).alias("key"))
    probes = marked.select(
        F.col("fp").alias("p"), F.col("star").alias("p_star"), F.explode(_keys(F.col("fp"), segments, k, balls=True)).alias("p_key")
    )
    found = probes.join(
        entries,
        (F.col("p_key") == F.col("key")) & (F.col("p") < F.col("fp")) & near("p", "fp") & (F.col("p_star") != F.col("star")),
    )
    star_links = stars.select(F.explode("hubs").alias("a"), F.col("fp").alias("b"))
    return star_links.unionByName(found.select(F.col("p").alias("a"), F.col("fp").alias("b")))


def simhash_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    segments: int = SEGMENTS,
    carry: list[str] | None = None,
) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``.

    ``carry`` names further columns of the input to be returned; then ``component`` is returned too, a
    number that tells components apart even where they share an identifier or have none.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), *(carry or []), fingerprint(F.col(text), shingle).alias("fp"))
    rows = saved(rows, "fingerprints")
    prints = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    roots = components(links(prints, max_bits, segments), "a", "b")
    placed = prints.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    placed = saved(placed, "placed")
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = placed.join(named, "root").select("fp", "component_id", F.col("root").alias("component"))
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.join(placed, "fp").select("doc_id", *(carry or []), shown, "component_id", *(["component"] if carry else []))
