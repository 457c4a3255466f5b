"""Hashes of words and word shingles, the same in every process."""

from __future__ import annotations

import re

import numpy as np

WORD = re.compile(r"\w+")
MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    """Runs of letters and digits, lower case; none for null."""
    return WORD.findall((text or "").lower())


def hash_words(words: list[str]) -> np.ndarray:
    """64-bit hashes of words, the same in every process; the empty word is 0."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    out = np.zeros(len(words), dtype=np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    starts = (np.cumsum(sizes) - sizes)[full]
    place = (np.arange(len(codes)) - np.repeat(starts, sizes[full])).astype(np.uint64)
    mixed = (codes + np.uint64(1)) * MIX ^ (place + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = (mixed ^ mixed >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    summed = np.add.reduceat(mixed ^ mixed >> np.uint64(29), starts)
    out[full] = (summed ^ summed >> np.uint64(32)) * np.uint64(0x94D049BB133111EB) | np.uint64(1)
    return out


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` words; fewer words are one shingle, no words none."""
    n = len(words) - size + 1
    if n < 1:
        size, n = len(words), min(len(words), 1)
    out = np.full(n, size, dtype=np.uint64)
    for j in range(size):
        out = (out ^ words[j : j + n]) * MIX
        out ^= out >> np.uint64(32)
    return out
