"""Quality classifier: a factorisation machine over hashed words, structure statistics and sizes.

The score of features x is ``w0 + sum w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]``:
all pairwise interactions at a cost linear in the number of features (the sum-of-squares
identity). It is fitted on a bounded sample of labelled rows (``max_train``; features are
computed by the executors, weights on the driver) and applied to every whole text in
Arrow batches, without a shuffle.

Defined results: NULL counts as empty; an empty text is scored from its statistics alone.
Without any labelled row, or with one class only, the score is the share of label 1
(0.5 without rows). Repeated rows get the same score. Other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labelled import labelled_sample

MAX_TRAIN = 8_000  # labelled rows that the weights are fitted on, at most
WORD_BUCKETS = 1 << 14
RANK = 8
STEPS = 60
THRESHOLD = 0.3
_BINS = 12
_ROWS_AT_ONCE = 512
#: The groups of characters whose shares are features.
CHARACTER_GROUPS = ["0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "|", "!?", "#$%&*", "<>{}[]()/\\=_~^`@+", ".,;:'\"-", "\n"]
_GROUP_OF = np.full(256, len(CHARACTER_GROUPS) + 1, np.uint8)  # the last group: bytes of no ASCII character
_GROUP_OF[:128] = len(CHARACTER_GROUPS)
for _i, _g in enumerate(CHARACTER_GROUPS):
    _GROUP_OF[list(_g.encode())] = _i
_STATS = len(CHARACTER_GROUPS) + 1 + 6
DIMENSIONS = WORD_BUCKETS + _STATS * _BINS


def _bin(share: float) -> int:
    """Shares from 0 to 1 on a logarithmic scale."""
    return min(_BINS - 1, int(np.log2(1024 * share + 1)))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of a text."""
    raw = (text or "").encode()
    words = raw.lower().split()
    n = len(words)
    h = np.fromiter(map(crc32, words), np.uint32, n)
    different, counts = np.unique(h, return_counts=True)
    buckets, where = np.unique(different % WORD_BUCKETS, return_inverse=True)
    values = np.sqrt(np.bincount(where, counts, len(buckets)) / max(n, 1))
    groups = np.bincount(_GROUP_OF[np.frombuffer(raw, np.uint8)], minlength=len(CHARACTER_GROUPS) + 2) / max(len(raw), 1)
    lines = raw.split(b"\n")
    stats = [_bin(x) for i, x in enumerate(groups) if i != len(CHARACTER_GROUPS)]
    stats += [
        _bin((h[1:] == h[:-1]).mean() if n > 1 else 0.0),
        _bin(len(different) / max(n, 1)),
        _bin(counts.max() / n if n else 0.0),
        _bin(1 - len(set(lines)) / len(lines)),
        min(_BINS - 1, int(np.log2(n + 1))),
        min(_BINS - 1, (len(raw) - n) // max(n, 1)),
    ]
    placed = WORD_BUCKETS + np.arange(_STATS) * _BINS + np.array(stats)
    return np.concatenate([buckets, placed]).astype(np.int32), np.concatenate([values, np.full(_STATS, 0.5)]).astype(np.float32)


def _rows(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row starts, feature numbers and values of several texts."""
    found = [features(t) for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(i) for i, _ in found])])
    return starts, np.concatenate([i for i, _ in found]), np.concatenate([x for _, x in found])


@dataclass
class FactorisationMachine:
    w0: float
    w: np.ndarray
    v: np.ndarray

    def margins(self, starts: np.ndarray, index: np.ndarray, x: np.ndarray) -> np.ndarray:
        at = starts[:-1]
        vx = self.v[index] * x[:, None]
        pairs = np.add.reduceat(vx, at) ** 2 - np.add.reduceat(vx * vx, at)
        return self.w0 + np.add.reduceat(self.w[index] * x, at) + 0.5 * pairs.sum(1)

    def scores(self, texts) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(*_rows(texts)), -30, 30))) if len(texts) else np.zeros(0)


def fit(starts, index, x, y: np.ndarray, steps: int = STEPS, rate: float = 0.05, decay: float = 1e-5, seed: int = 7) -> FactorisationMachine:
    """Logistic loss, full gradients, Adam steps."""
    rng = np.random.default_rng(seed)
    share = float(y.mean()) if len(y) else 0.5
    fm = FactorisationMachine(
        float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))), np.zeros(DIMENSIONS, np.float32),
        rng.normal(0, 0.05, (DIMENSIONS, RANK)).astype(np.float32),
    )
    if not 0 < share < 1:
        fm.v[:] = 0
        return fm
    parts = []
    for a in range(0, len(y), _ROWS_AT_ONCE):  # the gradient of all rows, in parts of bounded memory
        at = starts[a : a + _ROWS_AT_ONCE + 1]
        i, v = index[at[0] : at[-1]], x[at[0] : at[-1]]
        order = np.argsort(i, kind="stable").astype(np.int32)
        used, first = np.unique(i[order], return_index=True)
        parts.append((slice(a, a + len(at) - 1), at[:-1] - at[0], np.repeat(np.arange(len(at) - 1, dtype=np.int32), np.diff(at)), i, v, order, used, first))
    m, s = np.zeros((DIMENSIONS, RANK + 1), np.float32), np.zeros((DIMENSIONS, RANK + 1), np.float32)
    m0 = s0 = 0.0
    for t in range(1, steps + 1):
        grad, g0 = np.empty((DIMENSIONS, RANK + 1), np.float32), 0.0
        grad[:, 0], grad[:, 1:] = decay * fm.w, decay * fm.v
        for rows, at, row, i, v, order, used, first in parts:
            vx = fm.v[i] * v[:, None]
            sums = np.add.reduceat(vx, at)
            margin = fm.w0 + np.add.reduceat(fm.w[i] * v, at) + 0.5 * (sums**2 - np.add.reduceat(vx * vx, at)).sum(1)
            g = ((1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[rows]) / len(y)).astype(np.float32)
            gx = g[row] * v
            each = np.concatenate([gx[:, None], gx[:, None] * (sums[row] - vx)], 1)
            grad[used] += np.add.reduceat(each[order], first)
            g0 += float(g.sum())
        m, s = 0.9 * m + 0.1 * grad, 0.99 * s + 0.01 * grad * grad
        m0, s0 = 0.9 * m0 + 0.1 * g0, 0.99 * s0 + 0.01 * g0 * g0
        a, b = 1 - 0.9**t, 1 - 0.99**t
        step = rate * (m / a) / (np.sqrt(s / b) + 1e-9)
        fm.w -= step[:, 0]
        fm.v -= step[:, 1:]
        fm.w0 -= rate * (m0 / a) / (np.sqrt(s0 / b) + 1e-9)
    return fm


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_train: int = MAX_TRAIN, **names) -> FactorisationMachine:
    """Fit on at most ``max_train`` labelled rows that are not held out."""

    def featurised(batches):
        for b in batches:
            found = [features(t) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "label": b["label"], "i": [i for i, _ in found], "x": [x for _, x in found]})

    sample = labelled_sample(docs, labels, label, max_train, **names)
    kind = sample.schema["doc_id"].dataType.simpleString()
    rows = sample.mapInPandas(featurised, f"doc_id {kind}, label int, i array<int>, x array<float>").toPandas()
    rows = rows.sort_values("doc_id", kind="stable")  # the same sum in the same order in every run
    if rows.empty:
        return fit(np.zeros(1, int), np.zeros(0, int), np.zeros(0), np.zeros(0))
    starts = np.concatenate([[0], np.cumsum([len(i) for i in rows["i"]])])
    return fit(starts, np.concatenate(rows["i"].to_list()), np.concatenate(rows["x"].to_list()).astype(np.float32), rows["label"].to_numpy(np.float32))


def score(text: Column, model: FactorisationMachine, spark) -> Column:
    """The probability of label 1 for every text. The weights are of fixed size, and broadcast."""
    shared = spark.sparkContext.broadcast(model)

    def batch(texts: pd.Series) -> pd.Series:
        parts = [shared.value.scores(texts.iloc[i : i + 256].tolist()) for i in range(0, len(texts), 256)]
        return pd.Series(np.concatenate(parts).astype(float) if parts else np.zeros(0))

    return F.pandas_udf(batch, "double")(text)
