"""Words: maximal runs of characters other than space, tab, LF, VT, FF and CR."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

GAP = r"[\x20\x09-\x0D]+"
GAP_CHARACTERS = " \t\n\x0b\f\r"


def word_array(text: Column) -> Column:
    """The words of a text as an array; NULL and blank texts give an empty one."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(GAP_CHARACTERS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def lower_words(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text with A-Z in lower case.

    ``bytes.lower`` changes ASCII letters only and ``bytes.split`` cuts at the six
    ASCII space characters, which is the word rule above.
    """
    return text.lower().split() if text else []


class WordHashes(dict):
    """Word -> 63-bit hash, remembered for at most ``limit`` words."""

    def __init__(self, limit: int = 1 << 18):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word) >> 1
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_GAPS = np.isin(np.arange(256), list(GAP_CHARACTERS.encode()))
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_LONG = 64  # bytes of a word from which on it is hashed by itself


def lower_word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """63-bit hashes of the ``lower_words`` of all texts one after the other, and the number of each text.

    Words are cut and hashed eight bytes at a time for all texts together, without an object for each word.
    """
    parts = [text or b"" for text in texts]
    data = b" ".join([b"", *parts, bytes(8)]).lower()
    gap = _GAPS[np.frombuffer(data, np.uint8, len(data) - 8)]
    edges = np.flatnonzero(gap[1:] != gap[:-1]) + 1  # a gap comes first and last
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    bounds = np.cumsum([1, *(len(part) + 1 for part in parts)])
    counts = np.diff(np.searchsorted(starts, bounds))
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))  # the eight bytes from each place on
    out = eight[starts] & _MASKS[np.minimum(lengths, 8)]
    out = mixed(out ^ lengths.astype(np.uint64) * _ODD[0])
    at, more = 8, np.flatnonzero((lengths > 8) & (lengths <= _LONG))
    while len(more):
        rest = lengths[more] - at
        out[more] = mixed(out[more] * _ODD[1] ^ eight[starts[more] + at] & _MASKS[np.minimum(rest, 8)])
        at, more = at + 8, more[rest > 8]
    for k in np.flatnonzero(lengths > _LONG).tolist():
        out[k] = xxhash.xxh3_64_intdigest(data[starts[k] : starts[k] + lengths[k]])
    return out >> np.uint64(1), counts


_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(word_hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all ``n``-word shingles in order; shorter texts are one shingle as a whole."""
    if len(word_hashes) == 0:
        return np.zeros(0, np.uint64)
    width = min(n, len(word_hashes))
    count = len(word_hashes) - width + 1
    out = np.full(count, width, np.uint64)
    for k in range(width):
        out = mixed(out * _ODD[k % 3] + word_hashes[k : k + count])
    return out
