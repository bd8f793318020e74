"""Blocks of texts as numbers of words: a task's texts, each word of a block written once.

A block has its own numbering, the most frequent word first, so that most words of a text take one
byte.  The words of a block go through a shuffle of their own; what comes back for them is put in
place of the numbers, in order.
"""

from __future__ import annotations

import numpy as np


class Numbers(dict):
    """Numbers of words in order of first use."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


def by_frequency(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Old numbers in order of the new ones (ties as they were), and the new number of each."""
    order = np.argsort(-np.bincount(codes, minlength=size), kind="stable")
    new = np.empty(size, np.int32)
    new[order] = np.arange(size, dtype=np.int32)
    return order, new


def varints(codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Seven bits a byte, the lowest first, and where each number ends."""
    codes = codes.astype(np.uint32)
    sizes = np.ones(len(codes), np.int64)
    for bits in (7, 14, 21, 28):
        sizes += codes >= 1 << bits
    ends = np.cumsum(sizes)
    out = np.zeros(int(sizes.sum()), np.uint8)
    for k in range(int(sizes.max(initial=0))):
        has = sizes > k
        more = (sizes[has] > k + 1).astype(np.uint8) << 7
        out[ends[has] - sizes[has] + k] = ((codes[has] >> np.uint32(7 * k)) & np.uint32(127)).astype(np.uint8) | more
    return out.tobytes(), ends


def from_varints(data: bytes) -> np.ndarray:
    digits = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(digits < 128)
    if not len(ends):
        return np.zeros(0, np.int32)
    starts = np.r_[0, ends[:-1] + 1]
    sizes = ends - starts + 1
    longest = int(sizes.max())
    values = (digits[starts] & 127).astype(np.int32 if longest < 5 else np.int64)
    for k in range(1, longest):
        has = np.flatnonzero(sizes > k)
        values[has] |= (digits[starts[has] + k] & 127).astype(values.dtype) << (7 * k)
    return values


def gather(flat: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The runs of ``flat``, ``sizes`` long, that ``codes`` name, one after the other."""
    sizes = sizes.astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    wanted = sizes[codes]
    before = np.cumsum(wanted) - wanted
    return flat[np.repeat(starts[codes] - before, wanted) + np.arange(int(wanted.sum()))]
