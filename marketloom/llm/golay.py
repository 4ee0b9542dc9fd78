"""The perfect binary Golay code of length 23: nearest codeword of any word, and all codewords near it."""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

LENGTH = 23
_CHECKS = 11
# Fixed value: the code's generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
_GENERATOR = 0b110001110101


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, _CHECKS - 1, -1):
        if word >> bit & 1:
            word ^= _GENERATOR << (bit - _CHECKS)
    return word


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainder of each single bit by halves of a word, and the error pattern of each remainder."""
    single = [_remainder(1 << bit) for bit in range(LENGTH)]
    errors = np.zeros(1 << _CHECKS, dtype=np.int32)
    for weight in range(1, 4):  # perfect code: each remainder belongs to one pattern of at most three errors
        for bits in combinations(range(LENGTH), weight):
            syndrome = 0
            for b in bits:
                syndrome ^= single[b]
            errors[syndrome] = sum(1 << b for b in bits)

    def by_part(first: int, count: int) -> np.ndarray:
        out = np.zeros(1 << count, dtype=np.int32)
        for b in range(count):
            out[1 << b : 2 << b] = out[: 1 << b] ^ single[first + b]
        return out

    return by_part(0, 12), by_part(12, 11), errors


def nearest(words: np.ndarray) -> np.ndarray:
    """Index (0 to 4095) of the one codeword within three errors of each 23-bit word."""
    low, high, errors = _tables()
    words = words.astype(np.int32)
    return (words ^ errors[low[words & 0xFFF] ^ high[words >> 12]]) >> _CHECKS


def near(words: np.ndarray, bits: int = LENGTH) -> np.ndarray:
    """Indexes of the codewords nearest to each word and to it with one of its first `bits` bits changed.

    One column per change, repeats included. Two words that differ in one of these bits share the
    nearest index of either in the list of the other.
    """
    flips = np.array([0, *(1 << b for b in range(bits))], dtype=np.int32)
    return nearest(words.astype(np.int32)[:, None] ^ flips[None, :])
