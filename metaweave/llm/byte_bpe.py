"""Byte-level BPE encoding and decoding in Arrow batches.

A rank file becomes a tokenizer of the ``tokenizers`` library: every byte is mapped to
a printable character, and each pair of entries that joins to an entry is a merge, in the
order of the joined entry's rank. Texts are cut before white space into units that
no match of the split pattern crosses; each worker encodes a unit once and
remembers its ids (a bounded memo; a full memo is emptied and filled again). Decoding maps ids back to bytes through the reversed
byte table, so a character split over several ids comes out whole.

Defined results: NULL counts as empty; an empty text has no ids. Decoding unknown ids
raises. Other columns are untouched.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

MEMO_ENTRIES = 800_000  # about 250 bytes each


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself if printable Latin-1, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """Every split of an entry into two entries, in the order of the joined entry's rank."""
    out = []
    for token, _ in sorted(ranks.items(), key=lambda x: x[1]):
        out += [(token[:i], token[i:]) for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
    return out


def build_tokenizer(path: str, pattern: str):
    """The tokenizer of a rank file; ``pattern`` cuts texts into the pieces that are merged separately."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    chars, ranks = byte_characters(), read_ranks(path)
    shown = {token: "".join(chars[b] for b in token) for token in ranks}
    model = models.BPE(
        vocab={shown[t]: r for t, r in ranks.items()},
        merges=[(shown[a], shown[b]) for a, b in merges_of(ranks)],
        ignore_merges=True,
    )
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return tokenizer


_BLANK_RUN = re.compile(r"\s[ \n]")
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_MARK = "\x01"


def units(text: str) -> list[str]:
    """Cuts before every space or line feed that follows a character that is not white space."""
    if _MARK not in text and _BLANK_RUN.search(text) is None:
        return text.replace(" ", _MARK + " ").replace("\n", _MARK + "\n").split(_MARK)
    return _CUT.split(text)


def stem(unit: str) -> str | None:
    """The unit without one closing full stop or comma, which is a match of its own after a letter or digit."""
    if unit[-1:] in (".", ",") and unit[-2:-1].isascii() and unit[-2:-1].isalnum():
        return unit[:-1]
    return None


class Coder:
    """Encodes and decodes with one vocabulary; remembers the ids of units seen."""

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = build_tokenizer(path, pattern)
        back = {c: b for b, c in enumerate(byte_characters())}
        vocab = self.tokenizer.get_vocab()
        self.table = [b""] * (max(vocab.values()) + 1)
        for shown, i in vocab.items():
            self.table[i] = bytes(back[c] for c in shown)
        self.memo: dict[str, bytes] = {"": b""}

    def learn(self, texts: list[list[str]]) -> None:
        """Encode the units that are not remembered yet, together."""
        if len(self.memo) > MEMO_ENTRIES:
            self.memo = {"": b""}
        new = set().union(*texts).difference(self.memo)
        stems = {u: s for u in new if (s := stem(u))}
        self._encode(list({".", ","}.union(new.difference(stems), stems.values()).difference(self.memo)))
        for u, s in stems.items():
            self.memo[u] = self.memo[s] + self.memo[u[-1]]

    def _encode(self, new: list[str]) -> None:
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            e = self.tokenizer.encode_batch([part], add_special_tokens=False, is_pretokenized=True)[0]
            ids = np.array(e.ids, "<u4").tobytes()
            ends = (4 * np.searchsorted(np.array(e.word_ids, np.int64), np.arange(len(part) + 1))).tolist()
            for u, a, b in zip(part, ends, ends[1:]):
                self.memo[u] = ids[a:b]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        cut = [units(t) for t in texts]
        out = []
        for i in range(0, len(cut), 256):
            self.learn(cut[i : i + 256])
            look = self.memo.__getitem__
            out += [b"".join(map(look, u)) for u in cut[i : i + 256]]
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def offsets(self, text: str) -> list[tuple[int, int, int]]:
        """(id, first byte, byte after the last) for every id of the text; ids may split a character."""
        out, at = [], 0
        for i in np.frombuffer(self.encode_batch([text])[0], "<u4").tolist():
            out.append((i, at, at + len(self.table[i])))
            at += len(self.table[i])
        return out


@lru_cache(maxsize=4)
def coder(path: str, pattern: str) -> Coder:
    """One coder for each worker process."""
    return Coder(path, pattern)


def encode(text: Column, path: str, pattern: str) -> Column:
    """The ids of a text as ``array<int>``."""

    def batch(texts: pd.Series) -> pd.Series:
        rows = coder(path, pattern).encode_batch([t or "" for t in texts])
        return pd.Series([np.frombuffer(x, "<u4").astype(np.int32) for x in rows])

    return F.pandas_udf(batch, "array<int>")(text)


def decode(ids: Column, path: str, pattern: str) -> Column:
    """The bytes that an array of ids stands for; NULL ids have none."""

    def batch(rows: pd.Series) -> pd.Series:
        c = coder(path, pattern)
        return pd.Series([c.decode(np.array(x if x is not None else [], "<u4").tobytes()) for x in rows])

    return F.pandas_udf(batch, "binary")(ids)


def round_trip_digests(text: Column, path: str, pattern: str) -> Column:
    """Encodes, decodes the ids, and returns the number of ids with the digests of ids and decoded bytes."""

    def batch(texts: pd.Series) -> pd.DataFrame:
        c = coder(path, pattern)
        rows = c.encode_batch([t or "" for t in texts])
        return pd.DataFrame(
            {
                "n_tokens": [len(x) // 4 for x in rows],
                "ids_sha256": [hashlib.sha256(x).hexdigest() for x in rows],
                "decoded_sha256": [hashlib.sha256(c.decode(x)).hexdigest() for x in rows],
            }
        )

    return F.pandas_udf(batch, "n_tokens long, ids_sha256 string, decoded_sha256 string")(text)
