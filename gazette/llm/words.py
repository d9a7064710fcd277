"""Words, stable hashes and shingles that the text operators share.

A word is a maximal run of characters other than space and U+0009..U+000D.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, functions as F

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
_SEPARATORS = "\t\n\x0b\x0c\r"


def words(text: str | None) -> list[str]:
    """Words of a text in order; null and empty texts have none."""
    if not text:
        return []
    for c in _SEPARATORS:
        if c in text:
            text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def lower_az(text: str) -> str:
    """A-Z lower-cased, every other character as it is."""
    if text.isascii():
        return text.lower()
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def word_count(col: Column) -> Column:
    """Number of words as a column; null counts 0."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def word_array(col: Column) -> Column:
    """Words as an array column; null gives an empty array."""
    return F.coalesce(F.regexp_extract_all(col, F.lit(WORD_PATTERN), F.lit(0)), F.array().cast("array<string>"))


def crc_mod(id_col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo `mod`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % mod


class WordHashes(dict):
    """word -> stable 64-bit hash. Holds at most `limit` words, then starts again."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h

    def of(self, ws: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, ws), np.uint64, len(ws))


def mix(h: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values (multiply and shift, wrapping)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingles(h: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of `width` words. A text of 1 to width-1 words
    has one shingle, the whole text; an empty text has none."""
    n = len(h)
    if not n:
        return h
    k = min(width, n)
    acc = np.full(n - k + 1, k, np.uint64)
    for j in range(k):
        acc = acc * np.uint64(0x100000001B3) + mix(h[j:n - k + 1 + j])
    return np.unique(mix(acc))
