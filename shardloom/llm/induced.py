"""External induced sorting of suffixes, with common prefixes.

S* suffixes (smaller than their successor, after a larger one) are sorted first: the substrings
between them are named in order, and the string of names, a third as long, is sorted by recursion;
where names are too many for buckets of their own, by doubling, which is enough as only ``cap``
symbols matter.  Two scans then induce all others: a suffix tuple that leaves the queue of its first
symbol puts the suffix one place to the left into the queue of that one's first symbol.  Upwards
this yields the L suffixes, downwards the S suffixes.

Each tuple carries its common prefix with the tuple before it.  If two tuples of a queue come from
neighbours at places i < j of one queue, their common prefix is 1 + the least of those at i+1..j; if
they come from different queues, it is 1.

Queues are a priority queue with one lane per symbol: a lane is filled in order, and tuples enter
lanes that are yet to come, so a lane needs no order of its own.  Lanes beyond ``memory`` bytes lie
in files in a folder of the task and are read once.  Tuples of a lane are handled as arrays.
"""

from __future__ import annotations

import os
import tempfile
from collections import defaultdict
from collections.abc import Iterator

import numpy as np

#: Bytes of waiting tuples that stay in memory.
MEMORY = 64 << 20

#: More names than this are not given lanes of their own.
LANES = 1024


class Lanes:
    """Waiting tuples (suffix, common prefix) by symbol, on disk beyond ``memory`` bytes."""

    def __init__(self, folder: str, name: str, memory: int = MEMORY) -> None:
        self.folder, self.name, self.memory = folder, name, memory
        self.held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
        self.on_disk: set[int] = set()
        self.waiting: set[int] = set()
        self.size = 0

    def push(self, symbol: int, suffixes: np.ndarray, common: np.ndarray) -> None:
        self.held[symbol].append((suffixes, common))
        self.waiting.add(symbol)
        self.size += suffixes.nbytes + common.nbytes
        if self.size > self.memory:
            for lane, parts in self.held.items():
                for part, kind in zip(zip(*parts, strict=True), ("suffix", "common"), strict=True):
                    with open(self._path(lane, kind), "ab") as file:
                        np.concatenate(part).tofile(file)
                self.on_disk.add(lane)
            self.held.clear()
            self.size = 0

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        """All tuples of a lane, in the order in which they came."""
        parts = []
        if symbol in self.on_disk:
            paths = [self._path(symbol, kind) for kind in ("suffix", "common")]
            parts.append((np.fromfile(paths[0], np.int64), np.fromfile(paths[1], np.uint8)))
            for path in paths:
                os.remove(path)
            self.on_disk.discard(symbol)
        held = self.held.pop(symbol, [])
        self.size -= sum(a.nbytes + b.nbytes for a, b in held)
        parts += held
        self.waiting.discard(symbol)
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.uint8)
        return np.concatenate([a for a, _ in parts]), np.concatenate([b for _, b in parts])

    def _path(self, symbol: int, kind: str) -> str:
        return os.path.join(self.folder, f"{self.name}-{symbol}-{kind}")


class RangeMin:
    """Least of ``x[i..j]``, by tables of doubled spans."""

    def __init__(self, x: np.ndarray) -> None:
        self.tables = [x]
        span = 1
        while span * 2 <= len(x):
            last = self.tables[-1]
            self.tables.append(np.minimum(last[:-span], last[span:]))
            span *= 2

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.empty(len(i), self.tables[0].dtype)
        level = np.frexp((j - i + 1).astype(np.float64))[1] - 1
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            table, span = self.tables[k], 1 << int(k)
            out[at] = np.minimum(table[i[at]], table[j[at] - span + 1])
        return out


def _types(text: np.ndarray) -> np.ndarray:
    """True for S suffixes; the last symbol, the least of all, is S."""
    n = len(text)
    sign = np.r_[np.sign(np.diff(text.astype(np.int64))), 1]
    decides = np.where(sign != 0, np.arange(n), n)
    decides = np.minimum.accumulate(decides[::-1])[::-1]
    return sign[decides] > 0


def _runs(text: np.ndarray, cap: int) -> np.ndarray:
    """How often the symbol at each place is repeated from there on, at most ``cap``."""
    n = len(text)
    ends = np.where(np.r_[text[1:] != text[:-1], True], np.arange(n), n)
    ends = np.minimum.accumulate(ends[::-1])[::-1]
    return np.minimum(ends - np.arange(n) + 1, cap).astype(np.uint8)


def _names(text: np.ndarray, types: np.ndarray, stars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the substrings from each S* place to the next, and the name of each.

    Symbols compare by value, then type (L first); so none is a prefix of another.
    """
    symbols = 2 * text.astype(np.uint64) + types + 1
    bits = int(symbols.max()).bit_length()
    per = 63 // bits
    ends = np.r_[stars[1:], stars[-1]] + 1
    order = np.arange(len(stars))
    rank = np.zeros(len(stars), np.int64)  # of the element at each place of the order: its group's first place
    places, offset = np.arange(len(stars)), 0
    while len(places):
        own = order[places]
        chunk = np.zeros(len(own), np.uint64)
        for k in range(per):
            at = stars[own] + offset + k
            inside = at < ends[own]
            chunk = chunk << np.uint64(bits) | np.where(inside, symbols[np.minimum(at, len(text) - 1)], 0).astype(np.uint64)
        group = rank[places]
        by = np.lexsort((chunk, group))
        own, chunk, group = own[by], chunk[by], group[by]
        order[places] = own
        fresh = np.r_[True, (group[1:] != group[:-1]) | (chunk[1:] != chunk[:-1])]
        first = np.flatnonzero(fresh)
        rank[places] = places[first][np.cumsum(fresh) - 1]
        offset += per
        alone = np.diff(np.r_[first, len(places)]) == 1
        goes_on = ~np.repeat(alone, np.diff(np.r_[first, len(places)])) & (stars[own] + offset < ends[own])
        places = places[goes_on]
    named = np.empty(len(stars), np.int64)
    named[order] = np.cumsum(np.r_[False, rank[1:] != rank[:-1]])
    return order, named


def _common_ahead(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix of the suffixes ``a`` and ``b``, at most ``cap``."""
    out = np.zeros(len(a), np.uint8)
    going = np.arange(len(a))
    for k in range(cap):
        inside = (a[going] + k < len(text)) & (b[going] + k < len(text))
        going = going[inside]
        going = going[text[a[going] + k] == text[b[going] + k]]
        if not len(going):
            break
        out[going] = k + 1
    return out


def _by_doubling(text: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first ``cap`` symbols or more, and common prefixes."""
    n = len(text)
    levels, span = [np.unique(text, return_inverse=True)[1].astype(np.int64)], 1
    while span < cap and levels[-1].max() < n - 1:
        last = levels[-1]
        pair = last * (n + 1)
        pair[: n - span] += last[span:] + 1
        levels.append(np.unique(pair, return_inverse=True)[1].astype(np.int64))
        span *= 2
    order = np.argsort(levels[-1], kind="stable")
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = np.flatnonzero((a < n) & (b < n))
        same = inside[levels[k][a[inside]] == levels[k][b[inside]]]
        a[same] += 1 << k
        b[same] += 1 << k
        common[1:][same] += 1 << k
    return order, np.minimum(common, cap).astype(np.uint8)


def _sorted_stars(
    text: np.ndarray, types: np.ndarray, runs: np.ndarray, stars: np.ndarray, cap: int, folder: str,
    memory: int,
) -> tuple[np.ndarray, np.ndarray]:
    """S* suffixes in order, and common prefixes."""
    order, names = _names(text, types, stars)
    differ = np.r_[True, names[order][1:] != names[order][:-1]]
    firsts = stars[order[differ]]
    typed = 2 * text.astype(np.int64) + types
    name_common = np.r_[np.uint8(0), _common_ahead(typed, firsts[:-1], firsts[1:], cap)]
    if differ.all():
        equal = np.zeros(len(stars) - 1, np.int64)
    elif len(firsts) <= LANES:
        with tempfile.TemporaryDirectory(dir=folder) as inner:
            parts = list(induced(names.astype(np.uint16), cap, inner, memory))[::-1]
        order, equal = (np.concatenate(x) for x in zip(*parts, strict=True))
        equal = equal[1:].astype(np.int64)
    else:
        order, equal = _by_doubling(names, cap)
        equal = equal[1:].astype(np.int64)
    # From names to symbols: those of equal names; what the first different names share; and where
    # these part by type only, the symbol that both repeat.
    n = len(names)
    x, y = order[:-1], order[1:]
    xa, ya = np.minimum(x + equal, n - 1), np.minimum(y + equal, n - 1)
    low, high = np.minimum(names[xa], names[ya]), np.maximum(names[xa], names[ya])
    common = stars[xa] - stars[x]
    at = np.flatnonzero(low < high)
    common[at] += RangeMin(name_common).of(low[at] + 1, high[at])
    a, b = np.minimum(stars[x] + common, len(text) - 1), np.minimum(stars[y] + common, len(text) - 1)
    common += np.where(text[a] == text[b], np.minimum(runs[a], runs[b]), 0)
    common[equal >= cap] = cap
    return stars[order], np.r_[np.uint8(0), np.minimum(common, cap).astype(np.uint8)]


def _generations(first, common, text, chosen, cap):
    """Grow a lane in itself: suffixes one place to the left with the same symbol, and theirs.

    The g-th generation repeats the symbol g times, so it shares g symbols with the one before.
    """
    parts = [(first, common)]
    g = 1
    while len(first):
        left = first - 1
        at = np.flatnonzero((left >= 0) & (text[left] == text[first]))
        at = at[chosen[left[at]]]
        if not len(at):
            break
        grown = np.full(len(at), min(g, cap), np.uint8)
        if len(at) > 1:
            grown[1:] = np.minimum(RangeMin(common).of(at[:-1] + 1, at[1:]).astype(np.int64) + 1, cap)
        first, common = left[at], grown
        parts.append((first, common))
        g += 1
    return np.concatenate([a for a, _ in parts]), np.concatenate([b for _, b in parts])


def _pass_on(lanes: Lanes, suffixes, common, text, chosen, cap) -> None:
    """Put the suffixes one place to the left of those of a lane into their lanes."""
    left = suffixes - 1
    at = np.flatnonzero(left >= 0)
    at = at[chosen[left[at]] & (text[left[at]] != text[suffixes[at]])]
    if not len(at):
        return
    symbols = text[left[at]]
    order = np.argsort(symbols, kind="stable")
    at, symbols = at[order], symbols[order]
    same = symbols[1:] == symbols[:-1]
    carried = np.zeros(len(at), np.uint8)
    if same.any():
        i, j = at[:-1][same] + 1, at[1:][same]
        carried[1:][same] = np.minimum(RangeMin(common).of(i, j).astype(np.int64) + 1, cap)
    begin = np.flatnonzero(np.r_[True, ~same])
    for lo, hi in zip(begin.tolist(), [*begin[1:].tolist(), len(at)], strict=True):
        symbol = int(symbols[lo])
        carried[lo] = 1 if symbol in lanes.waiting else 0
        lanes.push(symbol, left[at[lo:hi]], carried[lo:hi])


def induced(
    text: np.ndarray, cap: int, folder: str, memory: int = MEMORY
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Lanes of the suffix array of ``text``, last lane first: suffixes in ascending order of their
    first ``cap`` symbols at least, and the common prefix (at most ``cap``) of each with the one
    before in its lane.  ``text`` ends with its least symbol, which is nowhere else."""
    types = _types(text)
    runs = _runs(text, cap)
    stars = np.flatnonzero(types & ~np.r_[True, types[:-1]])
    lasts = int(text.max())
    star_suffixes, star_common = _sorted_stars(text, types, runs, stars, cap, folder, memory)
    star_symbols = text[star_suffixes].astype(np.int64)
    bounds = np.searchsorted(star_symbols, np.arange(lasts + 2))

    larger = Lanes(folder, "larger", memory)
    done = Lanes(folder, "done", memory)
    for symbol in range(lasts + 1):
        suffixes, common = _generations(*larger.pop(symbol), text, ~types, cap)
        if len(suffixes):
            done.push(symbol, suffixes, common)
        lo, hi = bounds[symbol], bounds[symbol + 1]
        if lo < hi:
            meeting = star_common[lo:hi].copy()
            meeting[0] = min(runs[suffixes[-1]], runs[star_suffixes[lo]]) if len(suffixes) else 0
            suffixes = np.r_[suffixes, star_suffixes[lo:hi]]
            common = np.r_[common, meeting]
        if len(suffixes):
            _pass_on(larger, suffixes, common, text, ~types, cap)

    smaller = Lanes(folder, "smaller", memory)
    for symbol in range(lasts, -1, -1):
        # Downwards: common prefixes are with the suffix above.
        down, down_common = _generations(*smaller.pop(symbol), text, types, cap)
        if symbol == int(text[-1]):
            down, down_common = np.array([len(text) - 1]), np.zeros(1, np.uint8)
        up, up_common = done.pop(symbol)
        suffixes = np.r_[up, down[::-1]]
        if not len(suffixes):
            continue
        common = np.r_[up_common, np.zeros(len(down), np.uint8)]
        common[0] = 0
        if len(down) > 1:
            common[len(up) + 1 :] = down_common[:0:-1]
        if len(up) and len(down):
            common[len(up)] = min(runs[up[-1]], runs[down[-1]])
        yield suffixes, common
        _pass_on(smaller, suffixes[::-1], np.r_[np.uint8(0), common[:0:-1]], text, types, cap)
