"""Words and runs of words as 64-bit numbers, for code inside tasks."""

from __future__ import annotations

import numpy as np

U64 = np.uint64

_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_LETTERS = np.random.default_rng(64).integers(0, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_powers = [np.ones(1, U64), np.ones(1, U64)]


def _grown(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_powers[0]) < size:
        length = 1 << size.bit_length()
        for n, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            factors = np.full(length, base, U64)
            factors[0] = 1
            _powers[n] = np.multiply.accumulate(factors)
    return _powers[0], _powers[1]


def word_hashes(raw: bytes) -> np.ndarray:
    """One number for each word of a text: a polynomial over its bytes, from running sums over the whole text."""
    letters = np.frombuffer(raw, np.uint8)
    inside = np.zeros(len(letters) + 2, bool)
    inside[1:-1] = ~_BLANK[letters]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    powers, inverse = _grown(len(letters) + 1)
    sums = np.zeros(len(letters) + 1, U64)
    np.cumsum(_LETTERS[letters] * powers[:len(letters)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(U64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all others (the splitmix64 finaliser)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * U64(2) + U64(1)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """One number for each run of ``width`` consecutive words."""
    if len(hashes) < width:
        return np.empty(0, U64)
    places = len(hashes) - width + 1
    total = np.zeros(places, U64)
    for n, factor in enumerate(odd_numbers(width, width)):
        total += hashes[n:n + places] * factor
    return mixed(total)
