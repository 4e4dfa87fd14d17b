"""Word shingles as 64-bit numbers, for whole batches of texts at a time."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE_WORDS = 5

_MIX = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Words:
    """Numbers of words. What it remembers is bounded; a word's hash depends on the word only."""

    def __init__(self, most: int = 400_000):
        self.most, self.at, self.hashes = most, {}, []

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words of the texts in order, and how many words each text has."""
        if len(self.at) > self.most:
            self.at, self.hashes = {}, []
        at, hashes, places, counts = self.at, self.hashes, [], np.zeros(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            words = text.lower().split()
            for word in set(words).difference(at):
                at[word] = len(hashes)
                hashes.append(xxhash.xxh3_64_intdigest(word))
            places.append(np.fromiter(map(at.__getitem__, words), dtype=np.int64, count=len(words)))
            counts[i] = len(words)
        known = np.array(hashes, dtype=np.uint64)
        return (known[np.concatenate(places)] if places and len(known) else np.zeros(0, np.uint64)), counts


def shingles(words: Words, texts: list[str], size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles (repeats included) and the number of each text; a shorter text is one shingle."""
    hashes, counts = words.of(texts)
    made = np.maximum(counts - size + 1, np.minimum(counts, 1))
    if not len(hashes):
        return hashes, made
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    odd = [np.uint64(_ODD[k % 5] + np.uint64(2 * (k // 5))) for k in range(size)]
    start = np.concatenate([[0], np.cumsum(counts)[:-1]])
    place = np.repeat(start - np.concatenate([[0], np.cumsum(made)[:-1]]), made) + np.arange(made.sum())
    full = np.zeros(len(place), np.uint64)
    length = np.repeat(counts, made)
    for k in range(size):
        full += np.where(k < length, padded[place + k] * odd[k], np.uint64(0))
    return mix(full + np.minimum(length, size).astype(np.uint64) * _MIX), made
