"""The binary Golay code of length 23 as a fuzzy hash.

Spheres of radius 3 around its 4,096 codewords fill all words of 23 bits, so a
word lies within 3 of exactly one; it lies within 4 of that one only, or, if
3 away from it, of five more. A word's keys are the indices of the codewords
within 4. Two words that differ in one bit at most share a key: the codeword
within 3 of the one is within 4 of the other.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

LENGTH, DATA, REACH = 23, 12, 4
PARITY = LENGTH - DATA
#: Fixed value: the generator x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, a bit for each power.
GENERATOR = 0b110001110101


@cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The parity bits of all data words; for each syndrome the error patterns of REACH bits at most that have it, and their number."""
    word = np.arange(1 << DATA, dtype=np.int64) << PARITY
    for bit in range(LENGTH - 1, PARITY - 1, -1):
        word = np.where(word >> bit & 1, word ^ GENERATOR << (bit - PARITY), word)
    parity = word
    errors = np.array([sum(1 << b for b in bits) for n in range(REACH + 1) for bits in combinations(range(LENGTH), n)], np.int64)
    syndrome = errors & (1 << PARITY) - 1 ^ parity[errors >> PARITY]
    order = np.argsort(syndrome, kind="stable")
    n = np.bincount(syndrome, minlength=1 << PARITY)
    patterns = np.zeros((1 << PARITY, n.max()), np.int64)
    patterns[np.repeat(np.arange(len(n)), n), np.arange(len(errors)) - np.repeat(np.cumsum(n) - n, n)] = errors[order]
    return parity, patterns, n


def keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, key): the codeword indices within REACH of each word, with the word's place."""
    parity, patterns, n = tables()
    syndrome = words & (1 << PARITY) - 1 ^ parity[words >> PARITY]
    has = np.arange(patterns.shape[1]) < n[syndrome][:, None]
    return np.nonzero(has)[0], ((words[:, None] ^ patterns[syndrome]) >> PARITY)[has]
