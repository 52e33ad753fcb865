"""Shingle sets and b-bit MinHash signatures of texts."""

from __future__ import annotations

import numpy as np
import xxhash

from tallylake.llm.words import WordHashes, lower_words, mixed, shingles

CHUNKS = 12
CHUNK_SYMBOLS = 5
SYMBOLS = CHUNKS * CHUNK_SYMBOLS
SYMBOL_BITS = 16
CHUNK_ERRORS = 1
# By pigeonhole one of the chunks has at most CHUNK_ERRORS differing symbols.
MAX_DISTANCE = CHUNKS * (CHUNK_ERRORS + 1) - 1

_SEEDS = mixed(np.arange(1, SYMBOLS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_STEP = 1 << 14  # shingles hashed at a time


class Sketcher:
    """Sets and signatures; remembers word hashes from text to text."""

    def __init__(self, shingle_words: int):
        self.shingle_words = shingle_words
        self.hashes = WordHashes()

    def shingle_set(self, text: bytes | None) -> np.ndarray:
        """Sorted hashes of the distinct shingles of a UTF-8 text."""
        return np.unique(shingles(self.hashes.of(lower_words(text)), self.shingle_words))


def set_key(values: np.ndarray) -> bytes:
    """128 bits that name a shingle set."""
    return xxhash.xxh3_128_digest(values.tobytes())


def signature(values: np.ndarray) -> np.ndarray:
    """The low bits of one minimum per hash function over a non-empty set."""
    lowest = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(values), _STEP):
        part = values[start : start + _STEP]
        for k in range(SYMBOLS):
            hashed = part * _SEEDS[k]
            lowest[k] = min(lowest[k], (hashed ^ (hashed >> np.uint64(32))).min())
    return mixed(lowest).astype(np.uint16)


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """(documents, SYMBOLS) keys: every chunk with each one of its symbols left out.

    Two signatures within ``MAX_DISTANCE`` have a chunk with at most one differing symbol,
    and leaving that symbol out gives them an equal key.
    """
    wide = mixed(signatures.astype(np.uint64) + np.uint64(1))
    keys = np.empty(wide.shape, np.uint64)
    for left_out in range(SYMBOLS):
        first = left_out - left_out % CHUNK_SYMBOLS
        key = np.full(len(wide), left_out + 1, np.uint64)
        for k in range(first, first + CHUNK_SYMBOLS):
            if k != left_out:
                key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + wide[:, k])
        keys[:, left_out] = key
    return keys >> np.uint64(1)


def distance(a: bytes, b: bytes) -> int:
    """Differing symbols of two stored signatures."""
    return int((np.frombuffer(a, np.uint16) != np.frombuffer(b, np.uint16)).sum())
