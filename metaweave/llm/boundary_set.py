"""A compressed set of text offsets with rank and select, in containers of 65,536 offsets.

Offsets are dealt by their high bits. A container is a sorted array of up to 4,096 low halves, a bitmap
of 1,024 words, or a list of runs, whichever is smallest. Cumulative cardinalities over the
containers tell which of them holds the k-th offset; the rest is a local select: an index into
the array, a search over the bitmap's word counts, or one over the lengths of the runs.
"""

from __future__ import annotations

import numpy as np

_ARRAY_MAX = 4096
_WORDS = 1024


class _Array:
    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def __len__(self) -> int:
        return len(self.low)

    def nbytes(self) -> int:
        return 2 * len(self.low)

    def select(self, k: int) -> int:
        return int(self.low[k])

    def rank(self, x: int) -> int:
        """How many members are below ``x``."""
        return int(np.searchsorted(self.low, x))


class _Bitmap:
    def __init__(self, low: np.ndarray):
        bits = np.zeros(_WORDS * 64, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.ends = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)

    def __len__(self) -> int:
        return int(self.ends[-1])

    def nbytes(self) -> int:
        return 8 * _WORDS

    def _bits(self, word: int) -> np.ndarray:
        return np.unpackbits(self.words[word : word + 1].view(np.uint8), bitorder="little")

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.ends, k, side="right"))
        before = int(self.ends[word - 1]) if word else 0
        return 64 * word + int(np.flatnonzero(self._bits(word))[k - before])

    def rank(self, x: int) -> int:
        if x >= 64 * _WORDS:
            return len(self)
        word = x // 64
        return (int(self.ends[word - 1]) if word else 0) + int(self._bits(word)[: x % 64].sum())


class _Runs:
    def __init__(self, starts: np.ndarray, lengths: np.ndarray):
        self.starts, self.ends = starts, np.cumsum(lengths)
        self.lengths = lengths

    def __len__(self) -> int:
        return int(self.ends[-1])

    def nbytes(self) -> int:
        return 2 + 4 * len(self.starts)

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.ends, k, side="right"))
        return int(self.starts[run] + k - (self.ends[run] - self.lengths[run]))

    def rank(self, x: int) -> int:
        run = int(np.searchsorted(self.starts, x)) - 1
        if run < 0:
            return 0
        return int(self.ends[run] - self.lengths[run] + min(x - self.starts[run], self.lengths[run]))


def _container(low: np.ndarray) -> _Array | _Bitmap | _Runs:
    """The smallest form of sorted, different low halves."""
    first = np.flatnonzero(np.diff(low, prepend=-2) != 1)
    plain = 2 * len(low) if len(low) <= _ARRAY_MAX else 8 * _WORDS
    if 2 + 4 * len(first) < plain:
        return _Runs(low[first], np.diff(first, append=len(low)))
    return _Array(low) if len(low) <= _ARRAY_MAX else _Bitmap(low)


class BoundarySet:
    """A set of offsets from 0 on; ``members`` are sorted and different."""

    def __init__(self, members: np.ndarray):
        high = members >> 16
        cuts = np.flatnonzero(np.diff(high)) + 1
        parts = np.split(members, cuts) if len(members) else []
        self.keys = np.array([int(p[0]) >> 16 for p in parts], np.int64)
        self.containers = [_container((p & 0xFFFF).astype(np.int64)) for p in parts]
        self.ends = np.cumsum([len(c) for c in self.containers], dtype=np.int64)

    def __len__(self) -> int:
        return int(self.ends[-1]) if len(self.ends) else 0

    def nbytes(self) -> int:
        return sum(c.nbytes() for c in self.containers)

    def select(self, k: int) -> int:
        """The k-th smallest member, from 0."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.ends, k, side="right"))
        before = int(self.ends[at - 1]) if at else 0
        return (int(self.keys[at]) << 16) + self.containers[at].select(k - before)

    def rank(self, x: int) -> int:
        """How many members are below ``x``."""
        at = int(np.searchsorted(self.keys, x >> 16))
        before = int(self.ends[at - 1]) if at else 0
        if at == len(self.keys) or self.keys[at] != x >> 16:
            return before
        return before + self.containers[at].rank(x & 0xFFFF)
