"""Hashes of words, grams and stretches of many texts at once, on numpy arrays.

All sums and products are modulo 2**64.  A stretch is hashed as a polynomial over
the random values of its units, so that any stretch of an array follows from two
prefix sums.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_BASES = (0x9E3779B97F4A7C1B, 0xC2B2AE3D27D4EB53)
_TABLE = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def byte_values(data: np.ndarray) -> np.ndarray:
    return _TABLE[data]


def _power(base: int, exponent: int) -> np.uint64:
    return np.uint64(pow(base, exponent, 1 << 64))


@lru_cache(maxsize=8)
def _powers(base: int, log2: int) -> np.ndarray:
    """The first 2**log2 powers of a base."""
    powers = np.ones(1 << log2, np.uint64)
    for i in range(log2):
        powers[1 << i : 2 << i] = powers[: 1 << i] * _power(base, 1 << i)
    return powers


def _powers_of(base: int, n: int) -> np.ndarray:
    return _powers(base, max(16, (max(n, 1) - 1).bit_length()))[:n]


def stretches(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0) -> np.ndarray:
    """Hash of ``values[start:end]`` for each pair; the two lanes are independent."""
    base = _BASES[lane]
    inverse = pow(base, -1, 1 << 64)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers_of(base, len(values)), out=sums[1:])
    found = (sums[ends] - sums[starts]) * _powers_of(inverse, len(values) + 1)[starts]
    return mixed(found + (ends - starts).astype(np.uint64))


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words between ASCII blanks."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~BLANK[data]
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def grams(values: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` values, by doubling."""
    if len(values) < n:
        return np.zeros(0, np.uint64)
    total = len(values) - n + 1
    found, length, current, span = None, 0, values, 1
    while True:
        if n & span:
            if found is None:
                found, length = current, span
            else:
                rest = len(values) - length - span + 1
                found = found[:rest] * _power(_BASES[0], span) + current[length : length + rest]
                length += span
        if 2 * span > n:
            break
        current = current[:-span] * _power(_BASES[0], span) + current[span:]
        span *= 2
    return mixed(found[:total])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every run of ``width`` values."""
    if len(values) < width:
        return np.zeros(0, np.uint64)
    total, span = len(values) - width + 1, 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[:total], values[width - span : width - span + total])
