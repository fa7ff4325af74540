"""The perfect binary Golay code (23, 12): every 23-bit word is within 3 bits of exactly one
codeword. Words at most 2 bits apart share a word in the middle, 1 bit or less from either;
so the codewords nearest to a word and to its 23 one-bit changes (one or six of them) always
include one that the other word has as well. Their 12-bit indices are fuzzy hash keys."""

from __future__ import annotations

from functools import cache

import numpy as np

BITS = 23
#: Fixed value: the generator x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011


def _remainder(word: int) -> int:
    for high in range(word.bit_length() - 1, 10, -1):
        if word >> high & 1:
            word ^= GENERATOR << (high - 11)
    return word


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of the words with one byte set, and the error of each remainder. Remainders are
    linear: a word's is the exclusive or of its bytes'. 14 kB in all."""
    remainder = np.array([[_remainder(b << 8 * k) for b in range(256)] for k in range(3)], np.uint32)
    one = [1 << i for i in range(BITS)]
    patterns = one + [a | b for a in one for b in one if a < b]
    patterns += [a | b | c for a in one for b in one if a < b for c in one if b < c]
    error = np.zeros(1 << 11, np.uint32)
    error[[_remainder(p) for p in patterns]] = patterns
    return remainder, error


def nearest_index(words: np.ndarray) -> np.ndarray:
    """For each 23-bit word the 12-bit index (upper bits) of the nearest codeword."""
    remainder, error = _tables()
    left = remainder[0][words & 255] ^ remainder[1][words >> 8 & 255] ^ remainder[2][words >> 16]
    return ((words ^ error[left]) >> 11).astype(np.uint16)


def keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fuzzy keys of 23-bit words: (row, key) pairs, each key of a row once."""
    flips = np.array([0] + [1 << i for i in range(BITS)], np.uint32)
    found = np.sort(nearest_index(words.astype(np.uint32)[:, None] ^ flips), axis=1)
    new = np.ones(found.shape, bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    rows, places = np.nonzero(new)
    return rows, found[rows, places]
