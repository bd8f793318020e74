"""Remove repeated phrases: relative Lempel-Ziv parsing against indexed reference blocks.

``shardloom.llm.repeats`` brings all occurrences of a shared phrase to one block.  The phrases of
the smallest ids of a block are its reference; an index has the first place of every window of
``WINDOW`` words.  Each phrase is factored greedily: at a place whose window the reference has under
a smaller id, the match is followed as far as it goes, and the next factor begins behind it; a word
without such a window is a literal.  A window can repeat without lying inside one factor, so the
windows across the end of each factor are looked up as well.  Words covered by windows found are
removed.

Defined results: null and empty texts have no words and nothing to remove; very long texts are searched
whole; rows without an id count
as larger than all others; rows that repeat an id are not compared with each other; an empty table
gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from shardloom.llm.common import Query, read
from shardloom.llm.grams import word_bounds, word_hashes
from shardloom.llm.repeats import Kind, Units, find

WINDOW = 13
RUN = 5


def split(texts: list[bytes]) -> Units:
    joined = b"\n".join(texts)
    data = np.frombuffer(joined, np.uint8)
    starts, ends = word_bounds(data)
    offsets = np.cumsum([0, *(len(text) + 1 for text in texts[:-1])])
    row = np.searchsorted(offsets, starts, side="right") - 1

    def content(start: int, stop: int) -> bytes:
        return b" ".join(joined[starts[start] : ends[stop - 1]].split())

    return Units(word_hashes(data, starts, ends), row, content)


def window_names(words: np.ndarray, length: int) -> np.ndarray:
    """A number for each ``length`` consecutive words, equal for equal ones only: names of doubled
    lengths, then of two that overlap."""
    names, span = words, 1
    while span * 2 <= length:
        names = _pair_names(names[:-span], names[span:])
        span *= 2
    rest = length - span
    return _pair_names(names[: len(names) - rest], names[rest:]) if rest else names


def _pair_names(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    pairs = left.astype(np.int64) * (int(right.max(initial=0)) + 1) + right
    return np.unique(pairs, return_inverse=True)[1]


def looked_up(places: np.ndarray, firsts: np.ndarray, of: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Whether the windows at ``places`` are indexed for a smaller id; ``firsts`` is where they are."""
    return owners[of[firsts]] < owners[of[places]]


def parse(contents: list[bytes], owners: np.ndarray) -> np.ndarray:
    """Factor each phrase against those of smaller ids; a flag for each window."""
    split_up = [content.split(b" ") for content in contents]
    sizes = np.array([len(words) for words in split_up])
    words = pd.factorize(np.array([word for words in split_up for word in words], dtype=object))[0]
    begin = np.r_[0, np.cumsum(sizes)]
    of = np.repeat(np.arange(len(sizes)), sizes)
    names = window_names(words, WINDOW)
    inside = of[: len(names)] == of[WINDOW - 1 :]
    # The reference index: the first place of each window, of the smallest id as owners ascend.
    places = np.flatnonzero(inside)
    first_of = np.full(int(names.max(initial=0)) + 1, -1, np.int64)
    first_of[names[places][::-1]] = places[::-1]
    found = np.zeros(len(words), bool)

    at, end = begin[:-1].copy(), begin[1:]
    while True:
        open_ = np.flatnonzero(at + WINDOW <= end)
        if not len(open_):
            break
        here = at[open_]
        hit = looked_up(here, first_of[names[here]], of, owners)
        at[open_[~hit]] += 1
        phrase, here = open_[hit], here[hit]
        if not len(here):
            continue
        length = np.full(len(here), WINDOW, np.int64)
        back = first_of[names[here]]
        limit = np.minimum(end[phrase] - here, begin[of[back] + 1] - back)
        growing = np.flatnonzero(length < limit)
        while len(growing):
            more = words[here[growing] + length[growing]] == words[back[growing] + length[growing]]
            growing = growing[more]
            length[growing] += 1
            growing = growing[length[growing] < limit[growing]]
        # Windows inside the factor repeat as it does; those across its end are looked up.
        inner = length - WINDOW + 1
        step = np.arange(int(inner.sum())) - np.repeat(np.cumsum(inner) - inner, inner)
        found[np.repeat(here, inner) + step] = True
        across = (here + inner)[:, None] + np.arange(WINDOW - 1)[None, :]
        across = across[across + WINDOW <= end[phrase][:, None]]
        across = across[~found[across]]
        found[across] = looked_up(across, first_of[names[across]], of, owners)
        at[phrase] = here + length
    return found[places]


KIND = Kind(WINDOW, RUN, split, lambda text: len(text.split()), parse)


def _finish(rows: pd.DataFrame, texts: list[bytes], covered: list[np.ndarray]) -> pd.DataFrame:
    found = []
    for text, gone in zip(texts, covered, strict=True):
        words = text.split()
        kept = b" ".join(word for word, out in zip(words, gone.tolist(), strict=True) if not out)
        found.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    out = pd.DataFrame(found, columns=["n_words", "n_removed", "kept_sha256"])
    out.insert(0, "doc_id", rows["doc_id"].astype("Int64").array)
    return out


def removed_phrases(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` of every row."""
    return find(docs, KIND, _finish, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def op3_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed_phrases(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {"op3_phrase_dedup": op3_phrase_dedup}
ORACLES: dict[str, str] = {}
