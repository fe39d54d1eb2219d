"""Hashed word shingles of whole texts, with A-Z lower-cased."""

from __future__ import annotations

import numpy as np
import xxhash

from quernstone.llm.common import lower_ascii, words_of

WIDTH = 5
_rng = np.random.default_rng(20240501)
_FACTORS = _rng.integers(1, 1 << 63, WIDTH + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_digest = xxhash.xxh3_64_intdigest


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all others (a finalizer of xor-shifts and odd factors)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(text: str | None) -> np.ndarray:
    words = lower_ascii(b" ".join(words_of(text))).split() if text else []
    return np.fromiter(map(_digest, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """A 64-bit hash per position; fewer words than ``width`` make one shingle, none make none."""
    n = len(words)
    if not n:
        return words
    if n < width:
        return mix((words * _FACTORS[:n]).sum(keepdims=True) + _FACTORS[-1:] * np.uint64(n))
    total = words[: n - width + 1] * _FACTORS[0]
    for k in range(1, width):
        total += words[k : n - width + 1 + k] * _FACTORS[k]
    return mix(total)


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The distinct shingles of a text, sorted."""
    return np.unique(shingle_hashes(word_hashes(text), width))
