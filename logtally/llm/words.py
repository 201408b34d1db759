"""Words of whole texts as 64-bit numbers, in whole arrays."""

from __future__ import annotations

import numpy as np
import xxhash

WORD = 5
#: Words whose hashes a Python worker keeps between batches, some 20 MB; beyond it, it starts afresh.
KEPT_WORDS = 100_000


class WordHashes(dict):
    """Word (bytes) to its hash, worked out once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = WordHashes()


def split_words(text: str) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case; other letters stay as they are."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: list[bytes], size: int = WORD) -> np.ndarray:
    """The different word n-grams of a text, in order of their hashes. A shorter text is one n-gram; one without words has none."""
    h = word_hashes(words)
    if not len(h):
        return h
    width = min(size, len(h))
    total = np.full(len(h) - width + 1, width, np.uint64)
    for i in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - width + 1 + i]
    return np.unique(mixed(total))
