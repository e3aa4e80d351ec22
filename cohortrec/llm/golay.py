"""Fuzzy keys from the perfect binary (23, 12, 7) Golay code.

Every 23-bit word is within 3 bits of exactly one codeword. The keys of a word are the indices of
all codewords within 4 bits of it: one, or six where the nearest is 3 bits away. For two words that
differ in at most 2 bits some word lies within 1 bit of both, and its nearest codeword is within 4
bits of both, so they share a key.
"""

import functools
from itertools import combinations

import numpy as np

LENGTH, MESSAGE, CHECK = 23, 12, 11
GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
KEYS = 6
TOLERANCE = 2


def remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECK - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK)
    return word


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the upper bits; per syndrome the error patterns of up to 4 bits, and their number."""
    upper = np.array([remainder(m << CHECK) for m in range(1 << MESSAGE)], dtype=np.uint32)
    patterns: list[list[int]] = [[] for _ in range(1 << CHECK)]
    for weight in range(5):
        for bits in combinations(range(LENGTH), weight):
            word = sum(1 << b for b in bits)
            patterns[int(upper[word >> CHECK]) ^ (word & ((1 << CHECK) - 1))].append(word)
    count = np.array([len(p) for p in patterns])
    table = np.array([p + p[:1] * (KEYS - len(p)) for p in patterns], dtype=np.uint32)
    return upper, table, count


def keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices, ``(n, 6)``, and how many of each row count (the first ones)."""
    upper, table, count = _tables()
    words = words.astype(np.uint32)
    syndrome = upper[words >> CHECK] ^ (words & np.uint32((1 << CHECK) - 1))
    return (words[:, None] ^ table[syndrome]) >> np.uint32(CHECK), count[syndrome]
