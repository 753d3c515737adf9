"""The perfect binary Golay code of length 23: nearby codewords of any word, as table lookups.

Every 23-bit word lies within distance 3 of exactly one codeword. A word at distance 3 has five
more codewords at distance 4, a nearer word has none at distance 4 that matter here. For two
words at distance 1, of which the first has even weight, one of the first's codewords is the
nearest one of the second: so the even word gives all its keys, the odd one only its nearest.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

BITS = 23
CHECK = 11
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1


def _remainder(word: int) -> int:
    for bit in range(BITS - 1, CHECK - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK)
    return word


@cache
def _syndromes() -> list[np.ndarray]:
    """The remainders of all values of each byte of a word."""
    unit = [_remainder(1 << i) for i in range(24)]
    tables = []
    for byte in range(3):
        table = np.zeros(256, np.int64)
        for value in range(256):
            for bit in range(8):
                if value >> bit & 1:
                    table[value] ^= unit[8 * byte + bit]
        tables.append(table)
    return tables


@cache
def _errors() -> np.ndarray:
    """For each remainder six error patterns: the lightest, then those of weight 4; -1 if none."""
    unit = np.array([_remainder(1 << i) for i in range(BITS)])
    table = np.full((1 << CHECK, 6), -1, np.int64)
    used = np.zeros(1 << CHECK, np.int64)
    for weight in range(5):
        for places in combinations(range(BITS), weight):
            at = int(np.bitwise_xor.reduce(unit[list(places)])) if places else 0
            if weight < 4 or (used[at] and int(table[at, 0]).bit_count() == 3):
                table[at, used[at]] = sum(1 << p for p in places)
                used[at] += 1
    return table


def nearby(words: np.ndarray) -> np.ndarray:
    """(n, 6) codeword indices: the nearest first, then those at distance 4; -1 where none."""
    low, middle, high = _syndromes()
    at = low[words & 255] ^ middle[words >> 8 & 255] ^ high[words >> 16]
    errors = _errors()[at]
    return np.where(errors < 0, -1, (words[:, None] ^ errors) >> CHECK)
