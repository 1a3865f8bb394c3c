"""Words that a tokenizer splits in an evident way, so that its split and normal form can be skipped."""

from __future__ import annotations

from string import punctuation


def split_tail(s: str) -> tuple[str, str]:
    """A word and the run of ASCII signs at its end, if the word before them ends in a letter or digit.

    Split patterns of letters, digits and runs of other signs always end a match there. (The one letter whose
    lower case ends in a mark, which would join the signs, is left out.)
    """
    core = s.rstrip(punctuation)
    return (core, s[len(core) :]) if core and core != s and core[-1].isalnum() and core[-1] != "\u0130" else (s, "")


def is_letters(s: str) -> bool:
    """Letters below U+0250 only: one match of any run of letters, and its own composed normal form."""
    return s.isalpha() and max(s) < "\u0250"


def without_split(tokenizer, byte_level):
    """The tokenizer for such words: no normal form, no split pattern, no cache (each word comes once)."""
    from tokenizers import normalizers

    tokenizer.normalizer = normalizers.Sequence([])
    tokenizer.pre_tokenizer = byte_level
    tokenizer.model._resize_cache(0)
    return tokenizer


def encode_words(tokenizer, words: list[str], at_once: int = 2_000):
    """(word, ids as little-endian unsigned 32-bit integers) of each word for itself."""
    import numpy as np

    for i in range(0, len(words), at_once):
        part = words[i : i + at_once]
        e = tokenizer.encode_batch([part], add_special_tokens=False, is_pretokenized=True)[0]
        ids = np.array(e.ids, "<u4").tobytes()
        ends = (4 * np.searchsorted(np.array(e.word_ids, np.int64), np.arange(len(part) + 1))).tolist()
        for w, a, b in zip(part, ends, ends[1:]):
            yield w, ids[a:b]
