"""Toxic spans by a linear-chain conditional random field over the tokens of whole texts.

The tags are T (toxic) and O. Labels mark documents, so tokens are labelled first:
a feature of a token (the word, or its first 3 to 6 letters) marks toxic tokens if it
occurs in enough toxic documents of the training sample and hardly in any clean one (near copies in the
sample, rows of one label that agree in 10 of 16 minima of word-shingle hashes, count once; counted by the executors). Lines labelled so train the field: log-likelihood gradients from
forward-backward marginals, Adam steps. The sample and the lines are bounded by
``MAX_TRAIN`` and ``MAX_LINES``; features are computed by the executors.

Every whole text is scored in Arrow batches without a shuffle: emissions are remembered
per word, forward and backward passes run over all documents of a chunk at once, and the
marginals give the document score (from the largest one and the expected number of toxic tokens, calibrated on the sample) and
the offsets of the spans.

Defined results: NULL counts as empty; an empty text gets the calibrated score of no toxic
token and no spans. Without toxic labelled rows nothing is marked and all scores are the same.
Repeated rows get the same score. Other columns are never read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, islice
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labelled import held_out, labelled_sample

MAX_TRAIN = 6_000  # labelled rows, at most half of them toxic
MAX_LINES = 12_000  # training lines, at most half of them with a toxic token
MIN_SHARE = 0.012  # of the toxic documents that a marking feature must occur in
MIN_DOCS = 5  # and at least so many
MIN_RATIO = 25.0  # how much likelier it must be in toxic documents
BUCKETS = 1 << 18
STEPS = 40
THRESHOLD = 0.5
SPAN_MARGINAL = 0.5
MEMO_ENTRIES = 400_000  # about 180 bytes each
_CHUNK = 1_500_000  # characters at once; a longer text is a chunk of its own
_PRIME = 4294967291
_MULTIPLY, _ADD = np.random.default_rng(7).integers(1, _PRIME, (2, 16)).tolist()  # sixteen orders of shingle hashes
_ALIKE = 10  # of their minima that near copies have in common
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def normal(token: bytes) -> str:
    """Lower case, without signs at the ends."""
    s = token.decode().lower()
    return s if s.isalnum() else _EDGES.sub("", s)


_SEEDS = {kind: crc32(f"{kind}\t".encode()) for kind in ("bias", "shape", "s3", "w", "p3", "p4", "p5", "p6", "lw", "lp", "rw", "rp")}


def _number(kind: str, s: str) -> int:
    """A hash of ``kind``, tab and ``s``."""
    return crc32(s.encode(), _SEEDS[kind]) % BUCKETS


def marking_features(s: str) -> list[int]:
    """The features that may mark a toxic token."""
    return [_number("w", s)] + [_number(f"p{k}", s[:k]) for k in range(3, min(6, len(s)) + 1)] if len(s) > 2 else []


def shape(s: str) -> str:
    kind = "-" if not s else "l" if s.isalpha() else "d" if s.isdigit() else "m"
    return f"{kind}{min(len(s), 12)}"


def own_features(s: str) -> list[int]:
    return [_number("bias", ""), _number("shape", shape(s)), _number("s3", s[-3:])] + marking_features(s)


def near_features(side: str, s: str) -> list[int]:
    """What a token adds to the emission of its neighbour."""
    return [_number(f"{side}w", s), _number(f"{side}p", s[:4])]


class _Parts(dict):
    """The weight of a part of words, which many words share, found once."""

    def __init__(self, weight):
        self.weight = weight

    def __missing__(self, s: str) -> float:
        self[s] = found = self.weight(s)
        return found


@dataclass
class Field:
    """Weights for T against O, transitions [from, to] for O = 0 and T = 1, and the calibration of document scores."""

    w: np.ndarray
    trans: np.ndarray
    slope: np.ndarray = field(default_factory=lambda: np.array([0.5, 0.5]))
    shift: float = 0.0
    entries: int | None = None  # tokens to remember; MEMO_ENTRIES if not given

    def __post_init__(self):
        self.parts: tuple[_Parts, ...] = ()
        self.memo: dict[bytes, int] = {}
        self.table = tuple(array("d") for _ in range(3))  # of each known token: its own weight, and what it adds to the next and to the one before

    def __getstate__(self):
        return {"w": self.w, "trans": self.trans, "slope": self.slope, "shift": self.shift, "entries": self.entries}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def remember(self, tokens: set[bytes]) -> None:
        """Sum the weights of ``own_features`` and ``near_features`` of each token."""
        if not self.parts:
            w = self.plain = self.w.tolist()  # read one by one, a list is faster
            first = w[_number("bias", "")]
            self.parts = (
                _Parts(lambda x: first + w[_number("shape", x)]),
                _Parts(lambda x: w[_number("s3", x)]),
                _Parts(lambda x: sum(w[_number(f"p{k}", x[:k])] for k in range(3, len(x) + 1))),
                _Parts(lambda x: w[_number("lp", x)]),
                _Parts(lambda x: w[_number("rp", x)]),
            )
        plain, memo, (own, left, right) = self.plain, self.memo, self.table
        shapes, tails, heads, left_heads, right_heads = self.parts
        for t in tokens:
            s = normal(t)
            memo[t] = len(own)
            e = shapes[shape(s)] + tails[s[-3:]]
            own.append(e + plain[_number("w", s)] + heads[s[:6]] if len(s) > 2 else e)
            left.append(plain[_number("lw", s)] + left_heads[s[:4]])
            right.append(plain[_number("rw", s)] + right_heads[s[:4]])

    def forget(self, kept: int) -> None:
        """All but the tokens that came first, most frequent tokens among them."""
        self.memo = dict(islice(self.memo.items(), kept))
        self.table = tuple(x[:kept] for x in self.table)
        self.parts = ()

    def emissions(self, texts: list[list[bytes]]) -> np.ndarray:
        """One log-odds of T for every token of the texts in a row."""
        if len(self.memo) > (most := self.entries or MEMO_ENTRIES):
            self.forget(most // 2)
        tokens = list(chain.from_iterable(texts))
        self.remember(set(tokens).difference(self.memo))
        flat = np.fromiter(map(self.memo.__getitem__, tokens), np.int32, len(tokens))
        if not len(flat):
            return np.zeros(0)
        own, left, right = (np.array(x)[flat] for x in self.table)
        e = own.copy()
        ends = np.cumsum([len(t) for t in texts])
        inner = np.ones(len(flat), bool)
        inner[ends[ends > 0] - 1] = False  # the last token of a text has no right neighbour
        e[1:] += np.where(inner[:-1], left[:-1], 0)
        e[:-1] += np.where(inner[:-1], right[1:], 0)
        return e


def _time_major(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of every token when tokens are laid out by position, longest texts first; and where positions start."""
    order = np.argsort(-lengths, kind="stable")
    rank = np.empty(len(lengths), np.int64)
    rank[order] = np.arange(len(lengths))
    longest = int(lengths.max())
    active = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(longest), side="right")
    starts = np.concatenate([[0], np.cumsum(active)])
    position = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return starts[position] + np.repeat(rank, lengths), starts


def forward_backward(e: np.ndarray, lengths: np.ndarray, trans: np.ndarray, with_pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Marginals of T, and the chances [token, from, to] of the tags of a token and the next one of its text.

    Two tags leave one unknown a token, the log-odds of the forward and of the backward values. The pair
    chances of a text's last token are zero.
    """
    some = lengths[lengths > 0]
    if not len(some):
        return np.zeros(0), np.zeros((0, 2, 2)) if with_pairs else None
    place, starts = _time_major(some)
    x = np.empty(len(e))
    x[place] = e
    (oo, ot), (to, tt) = trans
    r, back = x.copy(), np.zeros(len(e))
    steps = len(starts) - 1
    for t in range(1, steps):
        a, b = starts[t], starts[t + 1]
        prev = r[starts[t - 1] : starts[t - 1] + b - a]
        r[a:b] += np.logaddexp(ot, prev + tt) - np.logaddexp(oo, prev + to)
    for t in range(steps - 2, -1, -1):
        a, b = starts[t + 1], starts[t + 2]
        nxt = x[a:b] + back[a:b]
        back[starts[t] : starts[t] + b - a] = np.logaddexp(to, tt + nxt) - np.logaddexp(oo, ot + nxt)
    marginals = 1 / (1 + np.exp(-np.clip(r + back, -40, 40)))
    if not with_pairs:
        return marginals[place], None
    pairs = np.zeros((len(e), 2, 2))
    for t in range(steps - 1):
        a, b = starts[t], starts[t + 1]
        n = starts[t + 2] - b
        f, g = r[a : a + n], x[b : b + n] + back[b : b + n]
        four = np.stack([np.full(n, oo), ot + g, f + to, f + tt + g], 1)
        four = np.exp(four - four.max(1, keepdims=True))
        pairs[a : a + n] = (four / four.sum(1, keepdims=True)).reshape(-1, 2, 2)
    return marginals[place], pairs[place]


def fit_field(lines: list[list[str]], tags: list[np.ndarray], steps: int = STEPS, rate: float = 0.2, decay: float = 2e-6) -> Field:
    """Maximise the likelihood of the tags, from a field that only knows T to be rare."""
    model = Field(np.zeros(BUCKETS), np.zeros((2, 2)))
    if not lines:
        model.w[_number("bias", "")] = -10.0
        return model
    lengths = np.array([len(x) for x in lines])
    y = np.concatenate(tags).astype(float)
    inner = np.ones(len(y), bool)  # tokens with a right neighbour in their line
    inner[np.cumsum(lengths) - 1] = False
    pair = np.flatnonzero(inner)
    number: dict[str, int] = {}
    word = np.array([number.setdefault(s, len(number)) for x in lines for s in x])
    n, k = len(y), len(number)
    own = [own_features(s) for s in number]
    own_n = np.array([len(f) for f in own])
    own_at, own = np.cumsum(own_n) - own_n, np.array([i for f in own for i in f])
    left, right = (np.array([near_features(side, s) for s in number]) for side in "lr")
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[pair].astype(int), y[pair + 1].astype(int)), 1)
    m, s = np.zeros(BUCKETS), np.zeros(BUCKETS)
    mt, st = np.zeros((2, 2)), np.zeros((2, 2))
    model.w[_number("bias", "")] = np.log(y.mean() + 1e-6) - 2
    for t in range(1, steps + 1):
        e = np.add.reduceat(model.w[own], own_at)[word]
        e[pair + 1] += model.w[left].sum(1)[word[pair]]
        e[pair] += model.w[right].sum(1)[word[pair + 1]]
        p, pairs = forward_backward(e, lengths, model.trans, with_pairs=True)
        g = (p - y) / n  # per token; summed per word, then per feature
        grad = np.bincount(own, np.repeat(np.bincount(word, g, k), own_n), BUCKETS)
        grad += np.bincount(left.ravel(), np.repeat(np.bincount(word[pair], g[pair + 1], k), 2), BUCKETS)
        grad += np.bincount(right.ravel(), np.repeat(np.bincount(word[pair + 1], g[pair], k), 2), BUCKETS)
        grad += decay * model.w
        gt = (pairs[pair].sum(0) - seen) / n + decay * model.trans
        m, s = 0.9 * m + 0.1 * grad, 0.99 * s + 0.01 * grad**2
        mt, st = 0.9 * mt + 0.1 * gt, 0.99 * st + 0.01 * gt**2
        a, b = 1 - 0.9**t, 1 - 0.99**t
        model.w -= rate * (m / a) / (np.sqrt(s / b) + 1e-8)
        model.trans -= 0.25 * rate * (mt / a) / (np.sqrt(st / b) + 1e-8)
    return model


def doc_evidence(model: Field, texts: list[str | None]) -> np.ndarray:
    """Per text: the log-odds of its most toxic token, within +-12, and the log of its expected toxic tokens."""
    out = np.zeros((len(texts), 2))
    sizes = np.array([len(t or "") for t in texts], np.int64)
    order = np.argsort(-sizes, kind="stable")  # texts of like length together: the passes take as many steps as the longest has tokens
    chunk = np.cumsum(sizes[order]) // _CHUNK
    for part in np.split(order, np.flatnonzero(np.diff(chunk)) + 1) if len(order) else []:
        tokens = [(texts[i] or "").encode().split() for i in part]
        lengths = np.array([len(t) for t in tokens], np.int64)
        p, _ = forward_backward(model.emissions(tokens), lengths, model.trans)
        top, expected = np.zeros((2, len(tokens)))
        some = np.flatnonzero(lengths)
        if len(some):
            at = (np.cumsum(lengths) - lengths)[some]
            top[some], expected[some] = np.maximum.reduceat(p, at), np.add.reduceat(np.where(p > 0.01, p, 0), at)
        top = np.clip(top, 1e-12, 1 - 1e-12)
        out[part, 0] = np.clip(np.log(top) - np.log1p(-top), -12, 12)
        out[part, 1] = np.log(np.clip(expected, 0.01, 20))
    return out


def spans(model: Field, text: str | None, marginal: float = SPAN_MARGINAL) -> list[tuple[int, int, float]]:
    """(first character, character after the last, largest marginal) of every run of toxic tokens."""
    found = list(re.finditer(r"[^\x20\x09-\x0D]+", text or ""))
    tokens = [m.group().encode() for m in found]
    p, _ = forward_backward(model.emissions([tokens]), np.array([len(tokens)]), model.trans)
    out, open_ = [], False
    for m, x in zip(found, p.tolist()):
        if x < marginal:
            open_ = False
        elif open_:
            out[-1] = (out[-1][0], m.end(), max(out[-1][2], x))
        else:
            out.append((m.start(), m.end(), x))
            open_ = True
    return out


def _calibrate(model: Field, x: np.ndarray, y: np.ndarray, share: float) -> None:
    """Logistic map from evidence to the label, classes weighted to their share among all labels that are not held out."""
    if not 0 < share < 1 or not len(y) or not 0 < y.mean() < 1:
        model.slope, model.shift = np.zeros(2), float(np.log(max(share, 1e-4) / max(1 - share, 1e-4)))
        return
    weight = np.where(y > 0, share / y.mean(), (1 - share) / (1 - y.mean())) / len(y)
    a, b = np.array([0.3, 0.3]), 0.0
    for _ in range(3000):  # a convex loss of three parameters; the penalty keeps separable classes finite
        g = weight * (1 / (1 + np.exp(-np.clip(x @ a + b, -30, 30))) - y)
        a = np.maximum(0.02, a - 0.05 * (g @ x + 0.001 * a))
        b -= 0.5 * (g.sum() + 0.0001 * b)
    model.slope, model.shift = a, float(b)


def _sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per document: its different marking features and -1, and the minima of its word-shingle hashes (to tell near copies)."""
    for b in batches:
        feats, mins = [], []
        for t in b["text"]:
            words = [normal(x) for x in set(t.encode().split())]
            feats.append(np.unique(np.array([-1, *(f for s in words for f in marking_features(s))], np.int32)))
            w = t.encode().lower().split()
            h = np.array([crc32(b" ".join(w[i : i + 5])) for i in range(max(1, len(w) - 4))], np.uint64)
            mins.append([int(((h * np.uint64(k) + np.uint64(b)) % np.uint64(_PRIME)).min()) for k, b in zip(_MULTIPLY, _ADD)])
        yield pd.DataFrame({"doc_id": b["doc_id"], "label": b["label"], "feats": feats, "mins": mins})


def unlike(mins: np.ndarray) -> np.ndarray:
    """The rows, in order, that agree in fewer than ``_ALIKE`` minima with every row picked before."""
    picked, held = [], np.empty_like(mins)
    for i, row in enumerate(mins):
        if not len(picked) or ((held[: len(picked)] == row).sum(1) < _ALIKE).all():
            held[len(picked)] = row
            picked.append(i)
    return np.array(picked, np.int64)


def lexicon(sample: DataFrame, min_share: float = MIN_SHARE, min_ratio: float = MIN_RATIO) -> np.ndarray:
    """The marking features: frequent in toxic documents, near copies counted once, and rare in clean ones.

    The driver is sent sixteen numbers a row of the bounded sample, to pick one row of each group of near copies, and two
    counts for each feature that enough toxic documents hold (of ``BUCKETS`` at most).
    """
    kind = sample.schema["doc_id"].dataType.simpleString()
    rows = sample.mapInPandas(_sketch, f"doc_id {kind}, label int, feats array<int>, mins array<long>")
    rows = rows.groupBy("doc_id", "label").agg(F.min(F.struct("mins", "feats")).alias("least")).persist()
    try:
        mins = rows.select("doc_id", "label", "least.mins").toPandas().sort_values("doc_id", kind="stable")
        once = []
        for _, some in mins.groupby("label"):
            once += some["doc_id"].iloc[unlike(np.array(some["mins"].tolist(), np.int64))].tolist()
        once = sample.sparkSession.createDataFrame([(x,) for x in once], f"doc_id {kind}")
        each = rows.join(F.broadcast(once), "doc_id").select("label", F.explode("least.feats").alias("feature"))
        counts = each.groupBy("feature").agg(*[F.count_if(F.col("label") == y).alias(x) for y, x in enumerate(("clean", "toxic"))])
        counts = counts.where((F.col("feature") < 0) | (F.col("toxic") >= MIN_DOCS)).toPandas()
    finally:
        rows.unpersist()
    every = counts["feature"].to_numpy() < 0  # -1 is in every document
    clean, toxic = (float(counts.loc[every, x].sum()) for x in ("clean", "toxic"))
    found = counts[~every]
    ratio = ((found["toxic"] + 0.5) / (toxic + 1)) / ((found["clean"] + 0.5) / (clean + 1))
    marks = np.zeros(BUCKETS, bool)
    marks[found["feature"][(found["toxic"] >= min_share * toxic) & (ratio >= min_ratio)].to_numpy(np.int64)] = True
    return marks


def train(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", max_train: int = MAX_TRAIN, max_lines: int = MAX_LINES, **names
) -> Field:
    """Token labels, field and calibration from at most ``max_train`` labelled rows that are not held out."""
    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, label, max_train, by_class=True, **names).persist()
    try:
        kind = sample.schema["doc_id"].dataType.simpleString()
        shared = spark.sparkContext.broadcast(np.packbits(lexicon(sample)))

        def tagged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            toxic = np.unpackbits(shared.value).astype(bool)
            for b in batches:
                out = []
                for y, t in zip(b["label"], b["text"]):
                    for line in t.split("\n"):
                        words = [normal(x) for x in line.encode().split()]
                        tags = [y == 1 and any(toxic[f] for f in marking_features(s)) for s in words]
                        if words:
                            out.append((" ".join(s or "-" for s in words), "".join("T" if x else "O" for x in tags), any(tags)))
                yield pd.DataFrame(out, columns=["line", "tags", "toxic"])

        lines = sample.mapInPandas(tagged, "line string, tags string, toxic boolean").distinct()
        half = max_lines // 2
        picked = [lines.where(F.col("toxic") == x).orderBy(F.xxhash64("line"), "line", "tags").limit(half).toPandas() for x in (True, False)]
        if len(picked[0]):
            both = pd.concat(picked)
            model = fit_field([x.split(" ") for x in both["line"]], [np.array([c == "T" for c in x]) for x in both["tags"]])
        else:
            model = fit_field([], [])
        held = spark.sparkContext.broadcast(model)

        def weighed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield pd.DataFrame({"doc_id": b["doc_id"], "label": b["label"], "evidence": list(doc_evidence(held.value, b["text"].tolist()))})

        found = sample.mapInPandas(weighed, f"doc_id {kind}, label int, evidence array<double>").toPandas().sort_values("doc_id", kind="stable")
    finally:
        sample.unpersist()
    key = names.get("doc_id", "doc_id")
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key))
    share = known.groupBy(key).agg(F.max((F.col(label) > 0).cast("double")).alias("one")).agg(F.avg("one")).first()[0]
    _calibrate(model, np.array(found["evidence"].tolist()).reshape(-1, 2), found["label"].to_numpy(float), share or 0.0)
    return model


def scores(model: Field, texts: list[str | None]) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(doc_evidence(model, texts) @ model.slope + model.shift, -30, 30)))


def score(text: Column, model: Field, spark) -> Column:
    """The probability of label 1 for every text. The weights are of fixed size, and broadcast."""
    shared = spark.sparkContext.broadcast(model)
    return F.pandas_udf(lambda texts: pd.Series(scores(shared.value, texts.tolist())), "double")(text)


def toxic_spans(text: Column, model: Field, spark) -> Column:
    """The toxic spans of a text: character offsets and the largest marginal of each."""
    shared = spark.sparkContext.broadcast(model)

    def batch(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"start": a, "end": b, "marginal": p} for a, b, p in spans(shared.value, t)] for t in texts])

    return F.pandas_udf(batch, "array<struct<start:int,end:int,marginal:double>>")(text)
