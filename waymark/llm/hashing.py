"""Hashes of words and word sequences for the numpy parts; run inside Spark tasks."""

from __future__ import annotations

import numpy as np
import xxhash

CACHED_WORDS = 300_000
_MIX, _END = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """64-bit hashes of words; at most ``CACHED_WORDS`` are remembered by a worker."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHED_WORDS:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def finish(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole value."""
    x = (x ^ (x >> np.uint64(30))) * _END
    return (x ^ (x >> np.uint64(27))) * _MIX


def runs(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` consecutive words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = words[:n].copy()
    for j in range(1, k):
        acc *= _MIX
        acc += words[j:n + j]
    return finish(acc)


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """The distinct ``k``-word shingles, sorted; a shorter text is one shingle, no words are none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return np.unique(runs(words, min(k, len(words))))


def lowered_words(text: str | None) -> list[bytes]:
    """ASCII-lowered words of a text, split at ASCII white space."""
    return (text or "").encode("utf-8", "replace").lower().split()
