"""Fuzzy hash keys from the perfect binary Golay code (23, 12, 7).

Every 23-bit word lies within three bits of exactly one codeword. The keys of a word are
the indices of the codewords to which the word and its 23 one-bit neighbours decode: one
key if the word is within two bits of its codeword, else six. Two words that differ in at
most two bits have a neighbour in common, hence a key in common.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

LENGTH, CHECK = 23, 11
#: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, a fixed value: it generates the code.
GENERATOR = 0b101011100011


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECK - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK)
    return word


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the low 12 and the high 11 bits; the error that each remainder tells."""
    single = [_remainder(1 << i) for i in range(LENGTH)]

    def mix(bits: list[int]) -> np.ndarray:
        out = np.zeros(1, np.int32)
        for value in bits:
            out = np.concatenate([out, out ^ value])
        return out

    errors = np.zeros(1 << CHECK, np.int32)
    for weight in (1, 2, 3):
        for places in combinations(range(LENGTH), weight):
            syndrome = 0
            for p in places:
                syndrome ^= single[p]
            errors[syndrome] = sum(1 << p for p in places)
    return mix(single[:12]), mix(single[12:]), errors


def decode(words: np.ndarray) -> np.ndarray:
    """Index (0 to 4095) of the codeword nearest to each 23-bit word."""
    low, high, errors = _tables()
    words = words.astype(np.int32)
    syndrome = low[words & 0xFFF] ^ high[words >> 12]
    return (words ^ errors[syndrome]) >> CHECK


def keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the word, key) for each distinct key of each word."""
    flips = np.concatenate([[0], 1 << np.arange(LENGTH)]).astype(np.int32)
    found = np.sort(decode(words.astype(np.int32)[:, None] ^ flips), axis=1)
    new = np.ones(found.shape, bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    row, place = np.nonzero(new)
    return row, found[row, place]
