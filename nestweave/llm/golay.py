"""Fuzzy keys from the binary Golay code of length 23.

The code has 4,096 words that differ in 7 bits or more, and every 23-bit word is within 3 bits of
exactly one. Two words that differ in 2 bits or fewer have a word between them, one bit from each,
so the code word nearest to that one is within 4 bits of both. All code words within 4 bits of a
word, one or six of them, are therefore keys of which two such words always share one.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

LENGTH, CHECK_BITS = 23, 11
#: Fixed value: the generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
MOST_KEYS = 6


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECK_BITS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK_BITS)
    return word


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the lower 12 and the upper 11 bits; error patterns by remainder, -1 for none."""
    low = np.array([_remainder(x) for x in range(1 << 12)], dtype=np.int64)
    high = np.array([_remainder(x << 12) for x in range(1 << 11)], dtype=np.int64)
    errors: list[list[int]] = [[] for _ in range(1 << CHECK_BITS)]
    for weight in range(5):
        for places in combinations(range(LENGTH), weight):
            pattern = sum(1 << p for p in places)
            errors[_remainder(pattern)].append(pattern)
    table = np.full((len(errors), MOST_KEYS), -1, dtype=np.int64)
    for i, patterns in enumerate(errors):
        table[i, : len(patterns)] = patterns
    return low, high, table


def codeword_indices(words: np.ndarray) -> np.ndarray:
    """For every word its code words within 4 bits, as numbers below 4,096; -1 fills up to six."""
    low, high, table = _tables()
    patterns = table[low[words & 0xFFF] ^ high[words >> 12]]
    return np.where(patterns < 0, -1, (words[:, None] ^ patterns) >> CHECK_BITS)
