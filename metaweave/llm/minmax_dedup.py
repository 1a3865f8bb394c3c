"""Near duplicates by min-max hashing: word-pair sets, banded signatures, links confirmed on full sets.

A document's set holds its different two-word shingles. Every permutation of the hash space gives two values
of the signature, the smallest and the largest image of the set, so a signature of 240 values takes 120
evaluations; both agree for two sets with a probability of their Jaccard similarity. Bands of six
values are bucket keys. Two sets with similarity 0.8 share none of the 40 keys with a chance of about 5 in a million.

Equal sets are one entry from the start. Every entry is first compared with the smallest entry of each of its
buckets, and the links found this way give components. Buckets whose entries lie in one component are done. In
the others, entries outside the bucket's largest component are compared with all entries of other components. So a
dense group costs links in proportion to its size, and no pair that shares a bucket and could join two components is left
out. Before pairs leave that comparison, a parity sketch of the sets rules out those that differ in too many members; it
never rules out a pair that is alike. Every link is confirmed on the full sets (64-bit hashes of all shingles), which are
made once, for the candidates only.

Defined results: NULL, empty and blank texts have an empty set, ``n_shingles`` 0, and are linked with nothing, not even each
other. A text of one word has that word as its set. Rows with equal sets share a component whatever their
identifiers; ``component_id`` is the smallest identifier that is not NULL. ``kept`` is true where the
identifier equals it (two NULLs are equal), so repeated rows of one identifier are all kept. An empty table gives
an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_narrow, saved, with_place
from .components import components

SIMILARITY = 80  # per cent
SHINGLE = 2
PERMUTATIONS = 120
ROWS = 6  # signature values in a band
SEED = 42
SKETCH = 32  # 64-bit words
_CHUNK = 2048
_FILE, _POS = "file", "pos"


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the different shingles of a text."""
    w = (text or "").encode().lower().split()  # bytes: ASCII white space and A to Z only
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, w), np.uint64, len(w))
    size = min(shingle, len(w))
    out = np.full(len(w) - size + 1, size, np.uint64)
    for k in range(size):
        out = _mixed(out + h[k : len(h) - size + 1 + k])
    return np.unique(out)


class Permutations:
    """Random permutations of 64-bit numbers: exclusive or, then an odd factor."""

    def __init__(self, n: int, seed: int):
        rng = np.random.default_rng(seed)
        self.flips = rng.integers(0, 1 << 64, n, np.uint64)
        self.factors = rng.integers(0, 1 << 64, n, np.uint64) | np.uint64(1)

    def signature(self, members: np.ndarray) -> np.ndarray:
        """The smallest images under all permutations, then the largest."""
        low, high = None, None
        for i in range(0, len(members), _CHUNK):
            images = (members[i : i + _CHUNK] ^ self.flips[:, None]) * self.factors[:, None]
            a, b = images.min(1), images.max(1)
            low, high = (a, b) if low is None else (np.minimum(low, a), np.maximum(high, b))
        return np.concatenate([low, high])


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key of every band; keys of different bands differ too."""
    bands = signature.reshape(-1, rows)
    key = np.arange(1, len(bands) + 1, dtype=np.uint64)
    for k in range(rows):
        key = _mixed(key + bands[:, k])
    return key


def signed(text: Column, shingle: int, permutations: int, rows: int, seed: int) -> Column:
    """A struct of the set's size ``n``, its 128-bit ``digest`` and its band ``keys``."""

    def batch(texts: pd.Series) -> pd.DataFrame:
        by, out = Permutations(permutations, seed), []
        for t in texts:
            s = shingle_hashes(t, shingle)
            keys = band_keys(by.signature(s), rows).view(np.int64) if len(s) else np.zeros(0, np.int64)
            out.append((len(s), xxhash.xxh3_128_digest(s.tobytes()), keys))
        return pd.DataFrame(out, columns=["n", "digest", "keys"])

    return F.pandas_udf(batch, "n long, digest binary, keys array<long>")(text)


def parity_sketch(members: np.ndarray, words: int = SKETCH) -> np.ndarray:
    """``words`` * 64 bits; every member flips one.

    Two sketches differ in no more bits than their sets have members that the other lacks.
    """
    flips = np.bincount((members & np.uint64(words * 64 - 1)).astype(np.int64), minlength=words * 64) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view("<i8")


def full_set(text: Column, shingle: int) -> Column:
    """A struct of the hashes of all different shingles (``members``) and their parity ``sketch``."""

    def batch(texts: pd.Series) -> pd.DataFrame:
        sets = [shingle_hashes(t, shingle) for t in texts]
        return pd.DataFrame({"members": [s.view(np.int64) for s in sets], "sketch": [parity_sketch(s) for s in sets]})

    return F.pandas_udf(batch, "members array<long>, sketch array<long>")(text)


def _alike(n: str, m: str, similarity: int) -> Column:
    """Sizes that allow the similarity at all."""
    return 100 * F.least(n, m) >= similarity * F.greatest(n, m)


def _may_be(x: str, y: str, n: str, m: str, similarity: int) -> Column:
    """Sketches that allow the similarity at all: exact, since they never differ in too many bits."""
    differ = sum((F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))) for i in range(SKETCH)), F.lit(0))
    return (100 + similarity) * differ <= (100 - similarity) * (F.col(n) + F.col(m))


def _confirmed(pairs: DataFrame, full: DataFrame, similarity: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose full sets are alike."""
    left = full.select(F.col("sid").alias("a"), F.col("members").alias("x"))
    right = full.select(F.col("sid").alias("b"), F.col("members").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    sure = 100 * both >= similarity * (F.size("x") + F.size("y") - both)
    return saved(pairs.join(left, "a").join(right, "b").where(sure).select("a", "b"), "near-links")


def _crowded(sets: DataFrame) -> DataFrame:
    """``key``, ``sid``, ``n`` and the bucket's smallest ``hub``, for buckets of several sets."""
    entries = sets.select("sid", "n", F.explode("keys").alias("key"))
    hubs = entries.groupBy("key").agg(F.min("sid").alias("hub"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    return entries.join(hubs, "key")


def _full_sets(docs: DataFrame, sets: DataFrame, entries: DataFrame, shingle: int) -> DataFrame:
    """``sid``, ``members`` and ``sketch`` of every set that shares a bucket."""
    places = sets.join(entries.select("sid").distinct(), "sid").select("sid", f"place.{_FILE}", f"place.{_POS}")
    texts = join_narrow(docs, saved(places, "near-places"), [_FILE, _POS], "inner")
    full = texts.select("sid", full_set(F.col("text"), shingle).alias("x"))
    return saved(full.select("sid", "x.members", "x.sketch"), "near-sets")


def _across(entries: DataFrame, roots: DataFrame, full: DataFrame, similarity: int) -> DataFrame:
    """Pairs that share a bucket, lie in different components, were not compared yet, and may be alike."""
    own = entries.join(roots.select(F.col("node").alias("sid"), "root"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    own = saved(own, "near-marked")
    each = own.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"))
    main = each.groupBy("key").agg(F.max_by("root", F.struct("c", "root")).alias("main"), F.count(F.lit(1)).alias("roots"))
    own = own.join(main.where("roots > 1").drop("roots"), "key")
    own = saved(own.join(full.select("sid", "sketch"), "sid"), "near-mixed")
    probes = own.where("root <> main").select(
        "key", F.col("sid").alias("p"), F.col("n").alias("m"), F.col("root").alias("p_root"), F.col("sketch").alias("p_sketch")
    )
    once = (F.col("root") == F.col("main")) | (F.col("p") < F.col("sid"))
    new = (F.col("sid") != F.col("hub")) & (F.col("p") != F.col("hub"))
    fit = _alike("n", "m", similarity) & _may_be("sketch", "p_sketch", "n", "m", similarity)
    found = probes.join(own, "key").where((F.col("p_root") != F.col("root")) & once & new & fit)
    return found.select(F.least("p", "sid").alias("a"), F.greatest("p", "sid").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    similarity: int = SIMILARITY,
    shingle: int = SHINGLE,
    permutations: int = PERMUTATIONS,
    rows: int = ROWS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``."""
    own = with_place(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), _FILE, _POS)
    made = own.select("doc_id", _FILE, _POS, signed(F.col("text"), shingle, permutations, rows, seed).alias("s"))
    made = saved(made.select("doc_id", _FILE, _POS, "s.n", "s.digest", "s.keys"), "near-signatures")
    sets = made.where("n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("least"), F.min(F.struct(_FILE, _POS)).alias("place"), F.first("n").alias("n"), F.first("keys").alias("keys")
    )
    sets = saved(sets.withColumn("sid", F.monotonically_increasing_id()), "near-unique")

    entries = saved(_crowded(sets), "near-entries")
    full = _full_sets(own, sets, entries, shingle)
    sized = sets.select(F.col("sid").alias("hub"), F.col("n").alias("m"))
    stars = entries.where("hub < sid").select("hub", "sid", "n").distinct().join(sized, "hub").where(_alike("n", "m", similarity))
    links = _confirmed(stars.select(F.col("hub").alias("a"), F.col("sid").alias("b")), full, similarity)
    roots = components(links, "a", "b")
    more = _confirmed(_across(entries, roots, full, similarity), full, similarity)
    if not more.isEmpty():
        roots = components(more.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))), "a", "b")

    placed = sets.select("digest", "sid", "least").join(roots, F.col("sid") == F.col("node"), "left")
    placed = saved(placed.select("digest", "least", F.coalesce("root", "sid").alias("root")), "near-placed")
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = placed.join(named, "root").select("digest", "component_id")
    told = made.where("n > 0").select("doc_id", "n", "digest").join(placed, "digest").select("doc_id", "n", "component_id")
    told = told.unionByName(made.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))
    return told.select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
