"""The binary Golay code [23, 12, 7]: every word of 23 bits lies within three bits of exactly one codeword.

Two words that differ in one bit at most share a key if each word's keys are the indexes of the codewords that it
and its neighbours decode to: one key if the word is within two bits of its codeword, else six.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

LENGTH, DATA = 23, 12
CHECK = LENGTH - DATA
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECK - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK)
    return word


BIT_SYNDROMES = [_remainder(1 << bit) for bit in range(LENGTH)]


def _error_table() -> np.ndarray:
    """The error pattern of up to three bits for each of the 2048 syndromes."""
    table = np.zeros(1 << CHECK, np.int64)
    for weight in (1, 2, 3):
        for bits in combinations(range(LENGTH), weight):
            syndrome = 0
            for bit in bits:
                syndrome ^= BIT_SYNDROMES[bit]
            table[syndrome] = sum(1 << bit for bit in bits)
    return table


ERRORS = _error_table()


def syndromes(words: np.ndarray) -> np.ndarray:
    found = np.zeros(len(words), np.int64)
    for bit, syndrome in enumerate(BIT_SYNDROMES):
        found ^= (words >> bit & 1) * syndrome
    return found


def nearby(words: np.ndarray, bits: int) -> np.ndarray:
    """Indexes (12 bits) of the codewords that each word and its neighbours in the low ``bits`` decode to.

    One column for the word and one for each neighbour; a row holds repeats.
    """
    own = syndromes(words)
    flips = np.array([0, *(1 << bit for bit in range(bits))], np.int64)
    steps = np.array([0, *BIT_SYNDROMES[:bits]], np.int64)
    return ((words[:, None] ^ flips) ^ ERRORS[own[:, None] ^ steps]) >> CHECK
