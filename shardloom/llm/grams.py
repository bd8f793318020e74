"""Hashes of words and of runs of words or bytes, by whole-array arithmetic."""

from __future__ import annotations

import numpy as np

#: ASCII white space.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_rng = np.random.default_rng(20)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def _power(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.r_[np.uint64(1), np.full(max(n, 1024), _BASE, np.uint64)], dtype=np.uint64)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of ``data`` (bytes)."""
    inside = ~_SPACE[data]
    change = np.diff(np.r_[False, inside, False].astype(np.int8))
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.r_[0, np.cumsum(lengths)[:-1]]
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    letters = data[place + np.repeat(starts, lengths)]
    sums = np.add.reduceat(_BYTE[letters] * _power(int(lengths.max()))[place], first)
    return mix(sums + lengths.astype(np.uint64))


def run_hashes(units: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each ``k`` consecutive units, by doubling."""
    n = len(units) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, span, out, done = units, 1, None, 0
    base = np.array([_BASE])
    while True:
        if k & span:
            if out is None:
                out, done = power, span
            else:
                m = len(out) - span
                out, done = out[:m] * base + power[done : done + m], done + span
        if span * 2 > k:
            return mix(out[:n])
        power = power[:-span] * base + power[span:]
        base, span = base * base, span * 2


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:n], x[width - span : width - span + n])


def byte_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte."""
    return _BYTE[data]
