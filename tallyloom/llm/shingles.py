"""Sets of hashed word shingles in tasks: what the join and its verification both compute."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import xxhash

# Odd multipliers of a well-known 64-bit finaliser, and one increment per place in a shingle.
_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """64-bit hashes of words. Hashing a word costs less than remembering it, as most words of a corpus are rare."""

    def of_words(self, words: Iterable[bytes], n: int) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)

    def of(self, text: str | None, lower: bool = True) -> np.ndarray:
        """Hashes of the words of a text, A-Z lowered if asked; words end at ASCII white space."""
        raw = (text or "").encode()
        words = (raw.lower() if lower else raw).split()
        return self.of_words(words, len(words))


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words."""
    total = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        total += mix(words[k:k + len(total)] + np.uint64((k + 1) * _STEP % 2**64))
    return mix(total)


def shingle_set(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct shingles; fewer words than one shingle are one element together, none are an empty set."""
    if len(words) >= size:
        return np.unique(windows(words, size))
    return windows(words, len(words)) + np.uint64(len(words)) if len(words) else words


def shingle_sets(texts: Iterable[str | None], hashes: WordHashes, size: int = 5, together: int = 2 << 20) -> Iterator[np.ndarray]:
    """shingle_set of each text; texts of about ``together`` characters are hashed in one sweep."""
    held, length = [], 0
    for text in texts:
        held.append((text or "").encode().lower().split())
        length += len(text or "")
        if length >= together:
            yield from _sets(held, hashes, size)
            held, length = [], 0
    if held:
        yield from _sets(held, hashes, size)


def _sets(split: list[list[bytes]], hashes: WordHashes, size: int) -> Iterator[np.ndarray]:
    counts = [len(words) for words in split]
    flat = hashes.of_words(chain.from_iterable(split), sum(counts))
    grams = windows(flat, size) if len(flat) >= size else flat
    start = 0
    for n in counts:
        if n >= size:
            own = np.sort(grams[start:start + n - size + 1])
            yield own[np.append(True, own[1:] != own[:-1])]
        else:
            yield shingle_set(flat[start:start + n], size)
        start += n
