"""Word and shingle hashes of UTF-8 texts, in numpy."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

from .tokens import forget

_K, _C, _D = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def begin() -> None:
    """Called by tasks that hash words: what the worker remembers for other work is emptied."""
    forget()


def words(text: bytes) -> list[bytes]:
    """Words of a text with A-Z in lower case; bytes.split() cuts at exactly the six ASCII white space characters."""
    return text.lower().split()


def word_hashes(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _C
    h = (h ^ (h >> np.uint64(27))) * _D
    return h ^ (h >> np.uint64(31))


def shingle_set(found: list[bytes], n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of n-word shingles; of the whole sequence where it is shorter; none without words."""
    w = word_hashes(found)
    if not len(w):
        return w
    n = min(n, len(w))
    h = w[: len(w) - n + 1].copy()
    for j in range(1, n):
        h = h * _K + w[j : len(w) - n + 1 + j]
    return np.unique(mixed(h + np.uint64(n)))


def sequence_class(found: list[bytes]) -> tuple[int, int]:
    """128 bits, as two signed longs, that stand for the word sequence."""
    d = hashlib.md5(b" ".join(found)).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)
