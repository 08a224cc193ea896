"""Word-shingle sets and their minhash samples, in numpy."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

from martspark.llm.common import BoundedCache

WORDS = 5
SAMPLES = 64
_U = np.uint64
_MULTIPLIERS = np.random.default_rng(7).integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * _U(2) + _U(1)


def word_hashes() -> BoundedCache:
    return BoundedCache(lambda w: xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")))


def shingle_set(text: str | None, hashes: BoundedCache, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's lower-case ``words``-word shingles.

    A text of fewer words has one shingle, all of it; one without words has none.
    """
    tokens = (text or "").lower().split()
    if not tokens:
        return np.empty(0, _U)
    h = np.fromiter(map(hashes.__getitem__, tokens), _U, len(tokens))
    k = min(words, len(h))
    n = len(h) - k + 1
    with np.errstate(over="ignore"):
        s = np.full(n, k, _U)
        for j in range(k):
            s = (s ^ h[j:j + n]) * _U(0x9E3779B97F4A7C15)
            s ^= s >> _U(29)
    return np.unique(s)


def samples(shingles: np.ndarray) -> np.ndarray:
    """For each of ``SAMPLES`` shared random orders, the set's first shingle (32 bits of it).

    Two sets agree in a sample with the probability of their Jaccard similarity.
    """
    low = np.full(SAMPLES, np.iinfo(np.uint64).max, _U)
    with np.errstate(over="ignore"):
        for lo in range(0, len(shingles), 4096):
            part = shingles[lo:lo + 4096, None] * _MULTIPLIERS
            np.minimum(low, part.min(axis=0), out=low)
    return (low >> _U(32)).astype(np.uint32).view(np.int32)


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.md5(shingles.tobytes()).digest()
