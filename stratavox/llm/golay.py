"""The binary Golay code of length 23: nearest codewords by syndrome, built from its generator polynomial."""

from __future__ import annotations

import itertools

import numpy as np

#: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 generates the perfect (23, 12) code.
GENERATOR = 0xAE3
BITS = 23


def _remainder(word: np.ndarray) -> np.ndarray:
    r = word.astype(np.uint32).copy()
    for bit in range(BITS - 1, 10, -1):
        r ^= np.where((r >> bit) & 1, np.uint32(GENERATOR << (bit - 11)), 0).astype(np.uint32)
    return r


def _errors() -> np.ndarray:
    """The pattern of at most three errors for each of the 2,048 syndromes."""
    masks = np.array([sum(1 << b for b in c) for w in range(4) for c in itertools.combinations(range(BITS), w)], np.uint32)
    table = np.zeros(2048, np.uint32)
    table[_remainder(masks)] = masks
    return table


ERRORS = _errors()
#: Syndrome of each single bit; the syndrome of a word is the sum of those of its bits.
_LOW, _MID = _remainder(np.arange(1 << 12, dtype=np.uint32)), _remainder(np.arange(1 << 11, dtype=np.uint32) << 12)


def decode(word: np.ndarray) -> np.ndarray:
    """Index (the 12 data bits) of the codeword within three bits of each 23-bit word."""
    word = word.astype(np.uint32)
    return (word ^ ERRORS[_LOW[word & 0xFFF] ^ _MID[word >> 12]]) >> 11


def neighbour_indices(word: np.ndarray, bits: int) -> np.ndarray:
    """(n, bits + 1) indices: of each word, and of the words that differ from it in one of the lowest ``bits`` bits."""
    flips = np.concatenate([[0], 1 << np.arange(bits)]).astype(np.uint32)
    return decode(word.astype(np.uint32)[:, None] ^ flips[None, :])
