"""Words of a text as compared by the leak search, and their 64-bit hashes."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pandas as pd
import xxhash

_WORD = re.compile(r"[^\W_]+")
# combining marks of all kinds, the only signs that accents leave after decomposition
_MARKS = dict.fromkeys(
    c for c in range(0x300, 0x1F000) if unicodedata.category(chr(c)).startswith("M")
)
_MARKS.update(dict.fromkeys(range(0xE0100, 0xE01F0)))


def plain_words(text: str | None) -> list[str]:
    """Maximal runs of letters or digits without regard to case and accents.

    Marks are taken off before the runs are formed, so that vowel signs don't
    part a word. A null text has no words.
    """
    if not text:
        return []
    if text.isascii():
        return _WORD.findall(text.lower())
    bare = unicodedata.normalize("NFKD", text.casefold()).translate(_MARKS)
    return _WORD.findall(bare.casefold())


def hash_words(words: list[str]) -> np.ndarray:
    """64-bit hashes; every distinct word is hashed once."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    codes, unique = pd.factorize(np.asarray(words, dtype=object))
    own = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in unique), dtype=np.uint64, count=len(unique))
    return own[codes]
