"""Spelling variants: words one edit apart, found by blocked Gram matrices of letter counts.

A word is a vector of letter counts. Of words at most one edit apart, the squared distance of the vectors is 2 (one letter
replaced) or 1 (one more), so the product of a block's count matrix with its transpose gives every candidate;
candidates are verified on their letters. A block holds the words of one length and of the next.

Blocks are kept small without losing a pair: the letters are divided into groups of like weight, an edit changes
the counts of two groups at most, so two near words agree on the counts of all but two groups in some choice of
these. Every such choice is a block key, and a pair counts in the first choice on which it agrees. A block above
a fixed number of words is cut into tiles, and every two tiles meet in a cell of their own, so no task
holds more than one cell. Small blocks are multiplied together. The result is the same for any number of groups.

Defined results: NULL text has no words. Rows count as they are, repeated ones each time; a NULL identifier is empty in the
hash. Of near words with equal counts, the first in code-point order is the form. A form has at least twice its
word's count, so forms never run in a circle, and the root is reached in a few doublings. Columns that are not named
are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_narrow, saved

MIN_LENGTH = 5
MIN_COUNT = 3
DELETED = 97  # a run in a document loses a letter if its hash is divisible by it
TILE = 4096  # words of a block that are multiplied at once, fewer if they are very long
TILE_LETTERS = 1 << 22
_PACK = 256  # small blocks are multiplied together up to so many words
_FLUSH = 300_000
_SIZE = 256  # code points of letters are below
#: Lower-cases A to Z, keeps the other letters, and makes anything else a space; by code point up to U+00FF.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(_SIZE))


def runs(text: str | None) -> list[bytes]:
    """The letter runs of a text, A to Z lower-cased, one byte for a code point."""
    return (text or "").encode("latin-1", "replace").translate(_LETTERS).split()


def count_runs(held: Counter, doc_id: str, text: str | None) -> None:
    """Add the runs of a document to the counts; those that its hash names lose a letter."""
    own = runs(text)
    held.update(own)
    start = crc32(f"{doc_id}:".encode())
    for w in set(own):
        h = crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
        if h % DELETED == 0:
            k, at = own.count(w), h % len(w)
            held[w] -= k
            held[w[:at] + w[at + 1 :]] += k


def count_words(docs: DataFrame, doc_id: str, text: str, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word`` and its count ``n``, combined per task before the shuffle."""

    def counted(held: Counter) -> pd.DataFrame:
        long = [(w.decode("latin-1"), k) for w, k in held.items() if k and len(w) >= min_length]
        return pd.DataFrame(long, columns=["word", "n"]).astype({"word": object, "n": "int64"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        for b in batches:
            for i, t in zip(b["id"], b["text"]):
                count_runs(held, i, t)
                if len(held) >= _FLUSH:
                    yield counted(held)
                    held = Counter()
        yield counted(held)

    own = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text"))
    parts = own.mapInPandas(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all words in a row, and the words' lengths."""
    joined = "".join(words).encode("latin-1")
    return np.frombuffer(joined, np.uint8), np.fromiter(map(len, words), np.int64, len(words))


def letter_counts(flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Counts by word and code point."""
    at = np.repeat(np.arange(len(lengths)), lengths) * _SIZE + flat
    return np.bincount(at, minlength=len(lengths) * _SIZE).reshape(-1, _SIZE)


class LetterGroups:
    """Groups of letters of like weight, and a 64-bit hash of a word's counts in each."""

    def __init__(self, weights: dict[str, int], groups: int):
        load, own = [0] * groups, np.zeros(_SIZE, np.int64)
        order = sorted(range(_SIZE), key=lambda c: (-weights.get(chr(c), 0), c))
        for c in order:
            own[c] = min(range(groups), key=lambda g: (load[g], g))
            load[own[c]] += weights.get(chr(c), 0)
        factor = np.random.default_rng(12).integers(1, 1 << 62, _SIZE)
        self.factors = np.where(own[:, None] == np.arange(groups), factor[:, None], 0)
        self.choices = list(combinations(range(groups), groups - 2))

    def hashes(self, counts: np.ndarray) -> np.ndarray:
        """By word and group; they wrap round, and equal counts have equal hashes."""
        return counts @ self.factors

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        """By word and choice of groups."""
        mix = [2 * np.random.default_rng(100 + k).integers(1, 1 << 61) + 1 for k in range(hashes.shape[1])]
        return np.stack([sum((hashes[:, g] * mix[g] for g in c), np.zeros(len(hashes), np.int64)) for c in self.choices], 1)


def _prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading columns agree in each row."""
    differ = a != b
    return np.where(differ.any(1), differ.argmax(1), a.shape[1])


def one_edit(spelled: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of rows differ by one edit; ``b`` is as long as ``a`` or one longer, and all ``a`` are of one length."""
    if not len(a):
        return np.zeros(0, bool)
    n = int(lengths[a[0]])
    x, y = spelled[a, :n], spelled[b]
    longer = lengths[b] > n
    head = _prefix(x, y[:, :n])
    shifted = np.where(longer[:, None], y[:, 1 : n + 1], y[:, :n])
    tail = _prefix(x[:, ::-1], shifted[:, ::-1])
    return np.where(longer, head + tail >= n, head + tail == n - 1)


def near_pairs(words: list[str], blocks: np.ndarray, choice: np.ndarray, tiles: np.ndarray, cells: np.ndarray, by: LetterGroups, base: int) -> np.ndarray:
    """Pairs of rows that are near, of words of length ``base`` or one more, first in the choice of their block.

    In a cell of two tiles (its two numbers differ) only words of different tiles are paired.
    """
    flat, lengths = codes(words)
    counts = letter_counts(flat, lengths)
    spelled = np.zeros((len(words), base + 1), np.uint8)
    spelled[np.arange(base + 1) < lengths[:, None]] = flat
    used = np.flatnonzero(counts.any(0))
    # twice the sums of products stay exact: below 2^24 in single precision, below 2^53 in double
    x = counts[:, used].astype(np.float32 if (base + 1) ** 2 < 1 << 23 else np.float64)
    norm = (x * x).sum(1)
    short = np.flatnonzero(lengths == base)
    hashes = by.hashes(counts)
    found = []
    step = max(1, (1 << 22) // max(1, len(words)))
    for i in range(0, len(short), step):
        rows = short[i : i + step]
        square = norm[rows, None] + norm - 2 * (x[rows] @ x.T)
        a, b = np.nonzero(square <= 2)
        d, a = square[a, b], rows[a]
        two = lengths[b] == base
        fit = np.where(two, (d == 2) & (a < b), d == 1) & (blocks[a] == blocks[b])
        fit &= (cells[a, 0] == cells[a, 1]) | (tiles[a] != tiles[b])
        a, b = a[fit], b[fit]
        same = hashes[a] == hashes[b]
        agreed = np.stack([same[:, list(c)].all(1) for c in by.choices], 1)
        first = agreed.argmax(1) == choice[a]
        a, b = a[first], b[first]
        for j in range(0, len(a), 1 << 16):
            p, q = a[j : j + (1 << 16)], b[j : j + (1 << 16)]
            ok = one_edit(spelled, lengths, p, q)
            found.append(np.stack([p[ok], q[ok]], 1))
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole blocks of one base length, several small ones together; rows come sorted by base and block."""
    held, key = [], ["base", "choice", "key", "p", "q"]
    for b in batches:
        held.append(b)
        if sum(map(len, held)) < _PACK:
            continue
        rows = pd.concat(held, ignore_index=True)
        changed = (rows[key].to_numpy()[1:] != rows[key].to_numpy()[:-1]).any(1)
        cuts = np.flatnonzero(changed) + 1
        base = rows["base"].to_numpy()
        start = 0
        for c, following in zip(cuts, [*cuts[1:], None]):
            new_base = base[c] != base[start]
            if c - start >= _PACK or new_base or (following is not None and following - start > 2 * TILE):
                yield rows.iloc[start:c]
                start = c
        held = [rows.iloc[start:]]
    if held:
        rows = pd.concat(held, ignore_index=True)
        for _, part in rows.groupby("base", sort=False):
            yield part


def pairs_of(vocabulary: DataFrame, groups: int, tile: int = TILE) -> DataFrame:
    """``a``, ``an``, ``b``, ``bn``: every pair of near words once, with their counts."""
    letters = vocabulary.select(F.explode(F.split("word", "")).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("k"))
    by = LetterGroups({r["c"]: r["k"] for r in letters.collect()}, groups)  # no more rows than there are letters

    def keys(words: pd.Series) -> pd.Series:
        return pd.Series(list(by.keys(by.hashes(letter_counts(*codes(words.tolist()))))))

    keyed = saved(vocabulary.select("word", "n", F.pandas_udf(keys, "array<long>")(F.col("word")).alias("keys")), "spelling-keys")
    rows = keyed.select("word", "n", F.posexplode("keys").alias("choice", "key"))
    rows = rows.select("*", F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("base"))
    block = ["base", "choice", "key"]
    most = F.greatest(F.lit(2), F.least(F.lit(tile), F.floor(F.lit(TILE_LETTERS) / F.col("base"))))
    large = rows.groupBy(*block).agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > most)
    large = saved(large.select(*block, F.ceil(F.col("c") / most).alias("tiles")), "spelling-large")
    rows = join_narrow(rows, large, block, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    rows = rows.withColumn("tile", F.pmod(F.xxhash64("word"), F.col("tiles")))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("other"))
    rows = rows.select("word", "n", *block, "tile", F.least("tile", "other").alias("p"), F.greatest("tile", "other").alias("q"))
    dealt = rows.repartition(*block, "p", "q").sortWithinPartitions(*block, "p", "q")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _packed(batches):
            base = int(part["base"].iloc[0])
            where = part[["choice", "key", "p", "q"]].to_numpy(np.int64)
            blocks = np.cumsum(np.concatenate([[0], (where[1:] != where[:-1]).any(1)]))
            words, n = part["word"].tolist(), part["n"].to_numpy()
            near = near_pairs(words, blocks, where[:, 0], part["tile"].to_numpy(), where[:, 2:], by, base)
            if len(near):
                a, b = near.T
                yield pd.DataFrame({"a": [words[i] for i in a], "an": n[a], "b": [words[i] for i in b], "bn": n[b]})

    return dealt.mapInPandas(run, "a string, an long, b string, bn long")


def roots_of(forms: DataFrame) -> DataFrame:
    """``word`` and its ``root``, for rows of ``word`` and ``form``: every round doubles the steps taken."""
    at = saved(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-roots")
    while not at.where("moved").isEmpty():
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        at = saved(at, "spelling-roots")
    return at.select("word", "root")


def groups_for(words: int) -> int:
    """More groups for larger vocabularies, so that blocks stay small; the result does not depend on it."""
    return 4 + (words > 1 << 20) + (words > 1 << 23)


def spelling_variants(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    groups: int | None = None,
    tile: int = TILE,
) -> DataFrame:
    """One row per word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``."""
    vocabulary = saved(count_words(docs, doc_id, text, min_length, min_count), "spelling-words")
    pairs = saved(pairs_of(vocabulary, groups or groups_for(vocabulary.count()), tile), "spelling-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("bn").alias("m"))
    both = both.unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("an").alias("m")))
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), F.col("near").alias("form"))).alias("x")
    )
    told = vocabulary.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "x")
    form_n = -F.col("x.m")
    told = told.withColumn("form_n", F.when(form_n >= 2 * F.col("n"), form_n)).withColumn("form", F.when(F.col("form_n").isNotNull(), F.col("x.form")))
    told = saved(told.drop("x"), "spelling-forms")
    roots = roots_of(told.where("form IS NOT NULL").select("word", "form"))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
