"""Cost-balanced packing of documents into training sequences.

A piece of n tokens costs ``LINEAR * n + QUADRATIC * n * n`` (projections and attention
within the piece). Documents are tokenised in Arrow batches and packed in blocks of
about ``block_tokens`` within each task, so nothing is shuffled and memory is bounded. In a
block, every whole ``capacity`` of a long document is a sequence of its own. The rest is assigned
in descending order, each piece to the lowest-cost sequence that has room for it; where none has, the
lowest-cost sequence with any room is filled and what is left over is assigned
in its turn. The sequences of a block have exactly the block's tokens as their total
capacity: as many full ones as fit, and powers of two for the remainder, so nothing
is padded.

Defined results: NULL counts as empty; an empty document is its end token alone. Repeated
rows are documents of their own. Ties go to the first in input order. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from collections.abc import Iterator
from functools import cached_property
from itertools import chain, islice

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .plain_words import encode_words, is_letters, split_tail

CAPACITY = 4096
END = 2
LINEAR = 1.0
QUADRATIC = 1 / (6 * 1024)  # 4 d n^2 against 24 d^2 n operations a layer, for width d = 1024
BLOCK_TOKENS = 1 << 22
MEMO_ENTRIES = 400_000  # about 160 bytes each
MEMO_KEPT = 250_000  # of a full memo, the words that came first stay, most frequent words among them
#: Letters whose lower case is one letter of the same range, then a run of ASCII signs; all of them take the same way through :meth:`WordCoder._learn`.
_PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+)([!-/:-@\\[-`{-~]*)").fullmatch


class _Numbers(dict):
    """Numbers of words; a word that is new gets the next one."""

    def __init__(self, known=()):
        super().__init__(known)
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n


class _ByteLevel(dict):
    """By code point, the characters that stand for its bytes in the vocabulary."""

    def __missing__(self, c: int) -> str:
        from tokenizers import pre_tokenizers

        s = self[c] = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(c))[0][0]
        return s


class WordCoder:
    """Ids of whole texts, for tokenizers that drop white space; remembers the ids of words seen, all of them in one array.

    White space always ends a match of the split pattern and leaves no token, so a text's
    ids are those of its words in a row.
    """

    def __init__(self, path: str, entries: int | None = None, kept: int | None = None):
        self.path = path
        self.entries, self.kept = entries or MEMO_ENTRIES, kept or MEMO_KEPT
        self.number = _Numbers()
        self.ends = np.zeros(1, np.int64)  # of the ids of each word, by number; the first one is their start
        self.flat = np.zeros(0, "<u4")
        self.byte_level = _ByteLevel()

    def __getstate__(self):
        return self.path, self.entries, self.kept

    def __setstate__(self, state: tuple[str, int, int]):
        self.__init__(*state)

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.encode_special_tokens = True
        return tokenizer

    @cached_property
    def model(self):
        """The merges alone, for words of plain letters."""
        model = self.tokenizer.model
        model._resize_cache(0)  # each word comes once
        return model

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        out = []
        for i in range(0, len(texts), 256):
            cut = [(t or "").encode().split() for t in texts[i : i + 256]]
            if len(self.number) > self.entries:
                self._forget()
            counts = np.array([len(w) for w in cut])
            numbers = np.fromiter(map(self.number.__getitem__, chain.from_iterable(cut)), np.int64, counts.sum())
            if self.number.new:
                self._learn(self.number.new)
                self.number.new = []
            first, last = self.ends[numbers], self.ends[numbers + 1]
            upto = np.concatenate([[0], np.cumsum(last - first)])
            spots = np.repeat(first - upto[:-1], last - first)
            spots += np.arange(len(spots))
            raw = self.flat[spots].tobytes()
            bounds = (4 * upto[np.concatenate([[0], np.cumsum(counts)])]).tolist()
            out += [raw[a:b] for a, b in zip(bounds, bounds[1:])]
        return out

    def _learn(self, new: list[bytes]) -> None:
        """The tokenizer lower-cases letters itself; a run of signs at the end of a word has ids of its own."""
        cut, letters, others = [], set(), set()
        for w in new:
            s = w.decode()
            if plain := _PLAIN(s):
                core, tail = plain.groups()
                core = core.lower()
                letters.add(core)
            else:
                core, tail = split_tail(s)
                if is_letters(core) and is_letters(core.lower()):
                    core = core.lower()
                    letters.add(core)
                else:
                    others.add(core)
            if tail:
                others.add(tail)
            cut.append((core, tail))
        ids, learnt, unknown = {"": ()}, len(self.ends) - 1, []
        tokenize, byte_level = self.model.tokenize, self.byte_level
        for x in chain(letters, others):
            n = self.number.get(x.encode(), learnt)
            if n < learnt:
                ids[x] = self.flat[self.ends[n] : self.ends[n + 1]].tolist()
            elif x in letters:
                ids[x] = [t.id for t in tokenize(x.translate(byte_level))]
            else:
                unknown.append(x)
        for x, raw in encode_words(self.tokenizer, unknown):
            ids[x] = np.frombuffer(raw, "<u4").tolist()
        sizes = np.fromiter((len(ids[core]) + len(ids[tail]) for core, tail in cut), np.int64, len(cut))
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        flat = np.fromiter(chain.from_iterable(ids[x] for pair in cut for x in pair), "<u4", sizes.sum())
        self.flat = np.concatenate([self.flat, flat])

    def _forget(self) -> None:
        self.number = _Numbers(islice(self.number.items(), self.kept))
        self.ends = self.ends[: self.kept + 1].copy()
        self.flat = self.flat[: self.ends[-1]].copy()


def piece_cost(n):
    return LINEAR * n + QUADRATIC * n * n


def pack(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents with these lengths."""
    out, tails, sequences = [], [], 0
    for d, n in enumerate(lengths):
        whole = n // capacity
        out += [(d, k * capacity, capacity, sequences + k, 0) for k in range(whole)]
        sequences += whole
        if n % capacity:
            tails.append((-(n % capacity), d, whole * capacity))
    total = -sum(t[0] for t in tails)
    rest = total % capacity
    room = np.array([capacity] * (total // capacity) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1], np.int64)
    size, cost = room.copy(), np.zeros(len(room))
    heapq.heapify(tails)
    while tails:
        n, d, start = heapq.heappop(tails)
        n = -n
        fits = room >= n
        s = int(np.argmin(np.where(fits if fits.any() else room > 0, cost, np.inf)))
        take = min(n, int(room[s]))
        out.append((d, start, take, sequences + s, int(size[s] - room[s])))
        room[s] -= take
        cost[s] += piece_cost(take)
        if take < n:
            heapq.heappush(tails, (take - n, d, start + take))
    return out


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end: int = END,
    block_tokens: int = BLOCK_TOKENS,
    with_ids: bool = False,
    memo: tuple[int, int] | None = None,
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``,
    ``offset``, ``sequence_cost`` (the estimate for its whole sequence), and ``ids`` if asked for.

    ``memo`` is how many words a worker remembers, and how many of them a full memo keeps."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()
    # one coder for each worker process, dropped with its memo when the worker goes on to other work
    shared = docs.sparkSession.sparkContext.broadcast(WordCoder(tokenizer, *memo or ()))

    def packed(keys: list, ids: list[bytes], first: int) -> tuple[pd.DataFrame, int]:
        pieces = pack([len(x) // 4 for x in ids], capacity)
        d, start, length, sequence, offset = (np.array(x, np.int64) for x in zip(*pieces))
        parts = [ids[a][4 * b : 4 * (b + c)] for a, b, c, _, _ in pieces]
        costs = np.bincount(sequence, piece_cost(length))
        frame = pd.DataFrame(
            {
                "doc_id": pd.Series([keys[a] for a in d.tolist()], dtype="object"),
                "start": start,
                "length": length,
                "ids_crc32": np.array([zlib.crc32(p) for p in parts], np.int64),
                "doc_tokens": [len(ids[a]) // 4 for a in d.tolist()],
                "sequence_id": sequence + first,
                "offset": offset,
                "sequence_cost": costs[sequence],
            }
        )
        if with_ids:
            frame["ids"] = [np.frombuffer(p, "<u4").astype(np.int32) for p in parts]
        return frame, first + len(costs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, close = shared.value, np.array([end], "<u4").tobytes()
        first = TaskContext.get().partitionId() << 36
        keys, ids, held = [], [], 0
        for batch in batches:
            named = batch["doc_id"].astype("object").where(batch["doc_id"].notna(), None).tolist()
            texts = batch["text"].tolist()
            for i in range(0, len(texts), 256):
                new = [x + close for x in coder.ids(texts[i : i + 256])]
                keys += named[i : i + 256]
                ids += new
                held += sum(map(len, new)) // 4
                if held >= block_tokens:
                    frame, first = packed(keys, ids, first)
                    yield frame
                    keys, ids, held = [], [], 0
        if keys:
            yield packed(keys, ids, first)[0]

    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_cost double"
    return own.mapInPandas(run, schema + (", ids array<int>" if with_ids else ""))
