"""Hashes of all spans of a text from one running sum over its bytes."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BASE = 0xD1342543DE82EF97  # 3 modulo 4, so that neighbouring powers differ in nearly all bits
BASE = _U(_BASE)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: A number for each byte.
LETTERS = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_tables = [np.ones(1, _U), np.ones(1, _U)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2**64."""
    if len(_tables[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(1 << n.bit_length(), base, _U)
            steps[0] = 1
            _tables[i] = np.cumprod(steps, dtype=_U)
    return _tables[0][:n], _tables[1][:n]


def span_hashes(letters: np.ndarray, starts: np.ndarray | slice, ends: np.ndarray | slice) -> np.ndarray:
    """Polynomial hashes of the spans from ``starts`` to ``ends``; equal spans have equal ones wherever they stand."""
    up, down = _powers(len(letters) + 1)
    sums = np.zeros(len(letters) + 1, _U)
    np.cumsum(letters * up[:-1], dtype=_U, out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]
