"""Word shingles of texts as 64-bit numbers."""

from __future__ import annotations

import numpy as np
import xxhash

# Distinct words whose hashes one Python worker remembers; bounds memory, not results.
REMEMBERED_WORDS = 200_000

_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_FACTOR = 0xD6E8FEB86659FD93


class WordHashes(dict):
    """64-bit hash of each word, computed once per distinct word."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > REMEMBERED_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, nothing else changed."""
    return text.encode().lower().split() if text else []


def scrambled(values: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the value; one to one."""
    x = values ^ (values >> np.uint64(32))
    x = x * np.uint64(_FACTOR)
    x ^= x >> np.uint64(32)
    x = x * np.uint64(_FACTOR)
    return x ^ (x >> np.uint64(32))


def grams(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of `width` words, in order; none if there are fewer words."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    value = np.full(count, np.uint64(width))
    for at in range(width):
        value = value * np.uint64(_ODD[0]) + hashes[at : at + count]
    return scrambled(value)


def shingle_set(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingles; all words as one shingle if there are fewer than `width`."""
    return np.unique(grams(hashes, min(width, len(hashes)) or 1))
