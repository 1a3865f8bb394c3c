"""Language-model scores from a hashed maximum-entropy model with a class-factored softmax.

``P(word | history) = P(class | history) * P(word | class)``. The most frequent words and the end of
a text are classes of their own; every other word's class is a hash of its last letters, so
words never seen have a class too. ``P(class | history)`` is a softmax over hashed features: the
word before, the pair before (n-grams), and the word two before (skip). ``P(word | class)`` is
``(c + 1) / (N_class + V_class + 1)``, with all words of a class that were never seen sharing one event.

Jobs: (1) count the words of the training texts, combined per task before the shuffle;
(2) train: in every round each task makes gradient steps on its texts from the shared
weights, and the changes are averaged in a tree of small sums; the rounds together use
every training text once; (3) score all texts in numpy batches. Counts of the ``table_words`` most frequent
words (a fixed bound) are broadcast for scoring; all other words go through a join
with the whole count table, so no count is dropped.

Defined results: NULL counts as empty; an empty text is its end token alone. Without training texts every
count is zero and the classes are even. Repeated rows get the same score, and count as often as they occur. Words that
tie in frequency are taken in their own order. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain, islice
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, saved

TABLE_WORDS = 250_000  # words whose counts are broadcast for scoring, at most
CLASSES = 64
OWN_CLASSES = 23  # words that are a class of their own; class 0 is the end of a text
OWN_ROWS = 2048  # words with a feature number of their own; others share one by their last letters
SHARED_ROWS = 512
PAIR_ROWS = 1 << 13
ROUNDS = 2
FAN_IN = 16
RATE = 0.3
_WORDS = OWN_ROWS + SHARED_ROWS + 2  # and one each for the end and the beginning of a text
_ROWS = 2 * _WORDS + PAIR_ROWS + 1
_BATCH = 1024
_DOCS = 256
_FLUSH = 300_000
_COUNTED = 1024  # texts counted at once
_MEMO = 900_000  # words that a worker remembers, about 200 bytes each


def tail_class(word: Column) -> Column:
    """The class of a word that is not a class of its own."""
    return (F.crc32(F.right(word, F.lit(2)).cast("binary")) % (CLASSES - OWN_CLASSES - 1) + OWN_CLASSES + 1).cast("int")


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


@dataclass
class Vocabulary:
    """Fixed-size statistics that all tasks share; ``words`` in descending frequency."""

    words: list[bytes]
    counts: np.ndarray
    total: int
    different: int
    class_totals: np.ndarray  # [class]: tokens
    class_words: np.ndarray  # [class]: different words

    @cached_property
    def index(self) -> Index:
        """One for all tasks of a worker, whose copy of the broadcast keeps it; never made on the driver."""
        return Index(self)

    def priors(self) -> np.ndarray:
        return np.log((self.class_totals + 1) / (self.class_totals.sum() + CLASSES)).astype(np.float32)


class _Numbers(dict):
    """Numbers of words; a word that is new gets the next one."""

    def __init__(self, known):
        super().__init__(known)
        self.next, self.new = len(self), []

    def __missing__(self, word: bytes) -> int:
        n = self[word] = self.next
        self.next += 1
        self.new.append(word)
        return n


class _Hashes(dict):
    """By the last letters of words, a hash below ``size`` counted from ``first``."""

    def __init__(self, size: int, first: int):
        super().__init__()
        self.size, self.first = size, first

    def __missing__(self, tail: str) -> int:
        n = self[tail] = crc32(tail.encode()) % self.size + self.first
        return n


class Index:
    """Word numbers with their class, feature number and count, for one worker; grows with the words it meets."""

    def __init__(self, v: Vocabulary):
        self.v, m = v, len(v.words)
        self.tail_class = _Hashes(CLASSES - OWN_CLASSES - 1, OWN_CLASSES + 1)
        self.tail_row = _Hashes(SHARED_ROWS, OWN_ROWS)
        self.end, self.begin = m, m + 1
        self.number = _Numbers({w: i for i, w in enumerate(v.words)})
        self.number[b""] = m  # no word is empty: the end of a text
        self.number.next = m + 2
        cls, fid = self._describe(v.words, 0)
        self.cls = np.concatenate([cls, [0, 0]]).astype(np.int64)
        self.fid = np.concatenate([fid, [_WORDS - 2, _WORDS - 1]]).astype(np.int64)
        inside = np.log10(v.counts + 1) - np.log10(v.class_totals[cls] + v.class_words[cls] + 1)
        inside[cls <= OWN_CLASSES] = 0
        self.inside = np.concatenate([inside, [0, 0]])
        self.known = np.concatenate([v.counts > 0, [v.total > 0, False]])
        self.in_table = self.filled = len(self.cls)
        self.extra = self.number.new

    def reset(self) -> None:
        """Forget all words but those of the vocabulary."""
        n = self.filled = self.in_table
        self.number = _Numbers(islice(self.number.items(), n - 1))  # no word has the number of the beginning
        self.number.next, self.extra = n, self.number.new

    def _describe(self, words: list[bytes], first: int) -> tuple[np.ndarray, np.ndarray]:
        tails = [w.decode()[-3:] for w in words]
        cls = np.array([self.tail_class[t[-2:]] for t in tails], np.int64)
        fid = np.array([self.tail_row[t] for t in tails], np.int64)
        if first == 0:
            n = min(OWN_CLASSES, len(words))
            cls[:n] = np.arange(1, n + 1)
            n = min(OWN_ROWS, len(words))
            fid[:n] = np.arange(n)
        return cls, fid

    def numbers(self, texts: list[list[bytes]]) -> np.ndarray:
        """Beginning twice, words, end: for each text in a row."""
        if len(self.number) > _MEMO:
            self.reset()
        lengths = np.array([len(t) for t in texts]) + 3
        flat = np.full(lengths.sum(), self.begin, np.int32)
        spots = np.ones(len(flat), bool)
        firsts = np.cumsum(lengths) - lengths
        spots[firsts] = spots[firsts + 1] = False
        flat[spots] = np.fromiter(map(self.number.__getitem__, chain.from_iterable(chain(t, (b"",)) for t in texts)), np.int32, spots.sum())
        new = self.extra[self.filled - self.in_table :]
        if new:
            cls, fid = self._describe(new, 1)
            inside = -np.log10(self.v.class_totals[cls] + self.v.class_words[cls] + 1)
            n = self.filled = self.filled + len(new)
            if n > len(self.cls):  # room for as many again, so that arrays are seldom copied
                self.cls, self.fid, self.inside, self.known = (np.resize(x, 2 * n) for x in (self.cls, self.fid, self.inside, self.known))
            at = slice(n - len(new), n)
            self.cls[at], self.fid[at], self.inside[at], self.known[at] = cls, fid, inside, False
        return flat

    def examples(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the predicted tokens, their feature rows and classes."""
        place = np.flatnonzero(flat != self.begin)
        f = self.fid[flat]
        one, two = f[place - 1], f[place - 2]
        rows = np.stack([one, _WORDS + two, 2 * _WORDS + (one * 40503 + two * 2654435) % 1000003 % PAIR_ROWS], 1)
        return place, rows, self.cls[flat[place]]


def _logits(w: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """By token and class, the largest of each token zero."""
    z = w.take(rows[:, 0], axis=0)
    z += w.take(rows[:, 1], axis=0)
    z += w.take(rows[:, 2], axis=0)
    z += w[-1]
    z -= z[np.arange(len(z)), z.argmax(1)][:, None]  # numpy finds the place of the largest faster than its value
    return z


def log_softmax(w: np.ndarray, rows: np.ndarray) -> np.ndarray:
    z = _logits(w, rows)
    z -= np.log(np.exp(z).sum(1, keepdims=True))
    return z


def log_chance(w: np.ndarray, rows: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """The log probability of each token's own class."""
    z = _logits(w, rows)
    own = z[np.arange(len(cls)), cls]
    return own - np.log(np.exp(z, out=z).sum(1))


def row_sums(g: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different feature rows and the sums of ``g`` over the tokens that have them, added in the order of the tokens.

    Most rows of a batch occur once, so only the others are summed: in each round those that occur once more.
    """
    key = rows.T.astype(np.uint16).ravel()  # a key of 16 bits is sorted by radix
    order = np.argsort(key, kind="stable")
    key, token = key[order], order % len(rows)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    times = np.diff(first, append=len(key))
    most = np.argsort(-times, kind="stable")
    first, times = first[most], times[most]
    part = g.take(token[first], axis=0)
    left = np.searchsorted(-times, -np.arange(1, times[0]), side="left").tolist()  # rows that occur more than 1, 2, ... times
    if left:
        more = part[: left[0]].astype(np.float64)
        for k, n in enumerate(left, 1):
            more[:n] += g.take(token[first[:n] + k], axis=0)
        part[: left[0]] = more
    return key[first], part


def gradient_steps(w: np.ndarray, scale: np.ndarray, rows: np.ndarray, cls: np.ndarray, rate: float = RATE) -> None:
    """One adaptive step for a batch; changes ``w`` and the per-row ``scale`` in place."""
    g = _logits(w, rows)
    np.exp(g, out=g)
    g /= g.sum(1, keepdims=True)
    g[np.arange(len(cls)), cls] -= 1
    used, part = row_sums(g, rows)
    held = scale[used] + np.einsum("ij,ij->i", part, part)
    scale[used] = held
    part *= (rate / np.sqrt(held + 1.0))[:, None]
    w[used] -= part
    part = g.sum(0)
    scale[-1] += (part * part).sum()
    w[-1] -= rate * part / np.sqrt(scale[-1] + 1.0)


def word_counts(texts: pa.Array) -> pa.Table:
    """``word`` and its count ``n`` of the :func:`tokens` of all texts."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.drop_null()))
    found = pc.value_counts(pc.list_flatten(split))
    found = pa.table({"word": found.field("values").cast(pa.string()), "n": found.field("counts")})
    return found.filter(pc.not_equal(found["word"], ""))  # beside white space at either end of a text


def _combined(parts: list[pa.Table]) -> pa.Table:
    found = pa.concat_tables(parts).group_by("word", use_threads=False).aggregate([("n", "sum")])
    return pa.table({"word": found["word"], "n": found["n_sum"]})


def count_words(train: DataFrame, text: str) -> DataFrame:
    """``word`` and its count ``n`` in all training texts; the end of a text is the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts = [], 0
        for b in batches:
            texts += len(b)
            for i in range(0, len(b), _COUNTED):
                held.append(word_counts(b.column(0).slice(i, _COUNTED)))
                if sum(map(len, held)) >= _FLUSH:
                    held = [_combined(held)]
                    if len(held[0]) >= _FLUSH:
                        yield from held.pop().to_batches()
        if texts:
            ends = pa.table({"word": pa.array([""], pa.string()), "n": pa.array([texts], pa.int64())})
            yield from _combined([*held, ends]).to_batches()

    parts = train.select(F.col(text).alias("text")).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, table_words: int = TABLE_WORDS) -> Vocabulary:
    """The bounded statistics of the whole count table."""
    # as many bins of counts, the largest first, as hold no more words than the table
    size = F.floor(F.log2("n") * 16)
    bins = sorted(((r["b"], r["v"]) for r in counts.where("word <> ''").groupBy(size.alias("b")).agg(F.count(F.lit(1)).alias("v")).collect()), reverse=True)
    held = np.cumsum([v for _, v in bins])
    fit = int(np.searchsorted(held, table_words, side="right"))
    least = bins[fit - 1][0] if fit else None
    top = counts.where("word <> ''").where(size >= least if fit else F.lit(False)).select("word", "n").toArrow()
    top = top.sort_by([("n", "descending"), ("word", "ascending")])
    own = top["word"][:OWN_CLASSES].to_pylist()
    cls = F.when(F.col("word") == "", F.lit(0))
    for i, w in enumerate(own):
        cls = cls.when(F.col("word") == w, F.lit(i + 1))
    per = counts.groupBy(cls.otherwise(tail_class(F.col("word"))).alias("c")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    totals, words = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in per:
        totals[r["c"]], words[r["c"]] = r["n"], r["v"]
    known = top["word"].cast("binary").to_pylist()
    return Vocabulary(known, top["n"].to_numpy().astype(np.int64), int(totals.sum()), int(words.sum()), totals, words)


def _summed(parts: DataFrame, n: int) -> np.ndarray | None:
    """The weighted mean of the tasks' weights, summed in a tree."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, seen = None, 0.0
        for b in batches:
            for raw, weight in zip(b["w"], b["weight"]):
                w = np.frombuffer(raw, np.float32) * np.float32(1)
                total = w if total is None else total + w
                seen += weight
        if total is not None:
            yield pd.DataFrame({"w": [total.tobytes()], "weight": [seen]})

    while n > 1:
        n = -(-n // FAN_IN)
        parts = parts.repartition(n).mapInPandas(add, "w binary, weight double")
    rows = parts.toArrow()  # one row, or none
    return np.frombuffer(rows["w"][0].as_py(), np.float32) / np.float32(rows["weight"][0].as_py()) if len(rows) else None


def train_weights(train: DataFrame, text: str, vocab, prior: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Gradient steps in every task, averaged after each round; a round takes its share of the texts."""
    spark = train.sparkSession
    w = np.zeros((_ROWS, CLASSES), np.float32)
    w[-1] = prior
    own = train.select(F.col(text).alias("text"), "part")
    n = min(own.rdd.getNumPartitions(), 2 * spark.sparkContext.defaultParallelism)
    for k in range(rounds):
        shared = spark.sparkContext.broadcast(w)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            index, weights = vocab.value.index, shared.value.copy()
            scale, seen = np.zeros(len(weights), np.float32), 0
            rng = np.random.default_rng(11)
            for b in batches:
                for i in range(0, len(b), _DOCS):
                    texts = [tokens(t) for t in b["text"].iloc[i : i + _DOCS]]
                    _, rows, cls = index.examples(index.numbers(texts))
                    order = rng.permutation(len(cls))
                    for j in range(0, len(order), _BATCH):
                        at = order[j : j + _BATCH]
                        gradient_steps(weights, scale, rows[at], cls[at])
                    seen += len(cls)
            if seen:
                yield pd.DataFrame({"w": [((weights - shared.value) * np.float32(seen)).tobytes()], "weight": [float(seen)]})

        parts = own.where(F.col("part") == k).coalesce(n).mapInPandas(run, "w binary, weight double")
        step = _summed(parts, n)
        if step is not None:
            w = (w + step.reshape(w.shape)).astype(np.float32)
        shared.destroy()  # the driver's copies go too
    return w


def lm_scores(
    docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text", carry: dict[str, Column] | None = None,
    table_words: int = TABLE_WORDS, rounds: int = ROUNDS,
) -> DataFrame:
    """One row per document: ``doc_id``, carried columns, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    ``training`` marks the rows to learn from. Scores are sums of log10 probabilities.
    """
    spark = docs.sparkSession
    extra = carry or {}
    part = F.pmod(F.xxhash64(F.col(doc_id)), F.lit(rounds)).alias("part")
    train = docs.where(training).select(F.col(text).alias("text"), part)
    counts = saved(count_words(train, "text"), "lm-counts")
    v = vocabulary(counts, table_words)
    vocab = spark.sparkContext.broadcast(v)
    weights = spark.sparkContext.broadcast(train_weights(train, "text", vocab, v.priors(), rounds))
    unit = float(np.log10(v.total + v.different + 1))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, w = vocab.value.index, weights.value
        base = np.log10(vocab.value.counts + 1) - unit
        end_base = np.log10(vocab.value.class_totals[0] + 1) - unit
        table = np.concatenate([base, [end_base, 0.0]])
        uid = TaskContext.get().partitionId() << 36
        for b in batches:
            for i in range(0, len(b), _DOCS):
                piece = b.iloc[i : i + _DOCS]
                texts = [tokens(t) for t in piece["text"]]
                flat = index.numbers(texts)
                place, rows, cls = index.examples(flat)
                said = np.empty(len(cls))
                for j in range(0, len(cls), _BATCH):
                    said[j : j + _BATCH] = log_chance(w, rows[j : j + _BATCH], cls[j : j + _BATCH])
                number = flat[place]
                said = said / np.log(10) + index.inside[number]
                at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])[:-1]
                plain = np.where(number < index.in_table, table[np.minimum(number, index.in_table - 1)], -unit)
                spots = np.flatnonzero(number >= index.in_table)
                cuts = np.searchsorted(spots, at[1:])
                rare = [Counter(x.tolist()) for x in np.split(number[spots], cuts)]
                out = piece.drop(columns="text").reset_index(drop=True)
                out["uid"] = np.arange(uid, uid + len(out))
                out["n_tokens"] = [len(t) + 1 for t in texts]
                out["n_known"] = np.add.reduceat(index.known[number].astype(np.int64), at)
                out["base_score"] = np.add.reduceat(plain, at)
                out["score"] = np.add.reduceat(said, at)
                out["rare"] = [[index.extra[x - index.in_table].decode() for x in c] for c in rare]
                out["often"] = [list(c.values()) for c in rare]
                uid += len(out)
                yield out

    own = docs.select(F.col(doc_id).alias("doc_id"), *[c.alias(k) for k, c in extra.items()], F.col(text).alias("text"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own.schema.fields if f.name != "text")
    scored = own.mapInPandas(
        run, fields + ", uid long, n_tokens long, n_known long, base_score double, score double, rare array<string>, often array<long>"
    )
    scored = saved(scored, "lm-scored")
    vocab.destroy()
    weights.destroy()
    rare = scored.select("uid", F.explode(F.arrays_zip("rare", "often")).alias("x")).select("uid", F.col("x.rare").alias("word"), F.col("x.often").alias("k"))
    found = (
        rare.join(counts, "word").groupBy("uid")
        .agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.log10(F.col("n") + 1)).alias("more"))
    )
    out = scored.drop("rare", "often").join(found, "uid", "left")
    more, k = F.coalesce("more", F.lit(0.0)), F.coalesce("k", F.lit(0))
    return out.select(
        "doc_id", *extra, "n_tokens", (F.col("n_known") + k).alias("n_known"), F.lit(v.total).cast("long").alias("train_tokens"),
        (F.col("base_score") + more).alias("base_score"), (F.col("score") + more).alias("score"),
    )


def held_out_fold(doc_id: str = "doc_id") -> Column:
    """Rows kept from training: crc32(doc_id) modulo 7 is 2."""
    return fold(F.col(doc_id), 7) == 2
