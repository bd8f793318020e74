"""Remove repeated byte strings by suffix sorting.

``shardloom.llm.repeats`` brings all pieces that can share a ``WINDOW``-byte string to one block.  A
piece that is alone with its anchor there shares no string with another one; a block sorts the suffixes
of its other distinct pieces by external induced sorting
(``shardloom.llm.induced``), which carries common prefixes along: suffixes in a row whose common
prefixes are ``WINDOW`` or more start with the same string, and all but those of the smallest id
repeat it.  Queues of a block lie on the task's disk beyond a fixed size, and lanes are judged one
by one.

Defined results: null texts are empty; texts shorter than a window lose nothing; very long texts are
searched whole; rows without an id count as larger than all others; rows that repeat an id are not compared with each other; an empty
table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import tempfile

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardloom.llm.common import Query, columns_of, read
from shardloom.llm.grams import byte_hashes, run_hashes
from shardloom.llm.induced import induced
from shardloom.llm.repeats import Kind, Units, find

WINDOW = 50
RUN = 20


def split(texts: list[bytes]) -> Units:
    joined = b"".join(texts)
    row = np.repeat(np.arange(len(texts), dtype=np.int32), [len(text) for text in texts])
    return Units(
        byte_hashes(np.frombuffer(joined, np.uint8)), row, lambda start, stop: joined[start:stop]
    )


def _met(contents: list[bytes]) -> np.ndarray:
    """Which pieces have the anchor of another one: equal windows have equal anchors, and all windows
    of a piece have that of the first."""
    heads = np.frombuffer(b"".join([content[:WINDOW] for content in contents]), np.uint8)
    runs = np.r_[run_hashes(byte_hashes(heads), RUN), np.zeros(RUN - 1, np.uint64)]
    anchors = runs.reshape(len(contents), WINDOW)[:, : WINDOW - RUN + 1].min(axis=1)
    _, number, times = np.unique(anchors, return_inverse=True, return_counts=True)
    return times[number] > 1


def judge(contents: list[bytes], owners: np.ndarray) -> np.ndarray:
    """A flag for each window of each piece: it starts in a piece of a smaller id, too."""
    if not contents:
        return np.zeros(0, bool)
    met = _met(contents)
    windows = np.array([len(content) - WINDOW + 1 for content in contents])
    found = np.zeros(int(windows.sum()), bool)
    if met.any():
        pieces = [content for content, is_met in zip(contents, met, strict=True) if is_met]
        found[np.repeat(met, windows)] = _sorted_out(pieces, owners[met])
    return found


def _sorted_out(contents: list[bytes], owners: np.ndarray) -> np.ndarray:
    """The flags of ``judge``, by sorting all suffixes."""
    # 0 ends the text, 1 ends a piece, bytes follow.
    joined = np.frombuffer(b"\0".join([*contents, b""]), np.uint8)
    text = np.r_[joined.astype(np.uint16) + np.uint16(2), np.uint16(0)]
    sizes = np.array([len(content) + 1 for content in contents])
    ends = np.cumsum(sizes) - 1
    text[ends] = 1
    of = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.zeros(len(text), bool)
    starts[:-1] = np.arange(len(of)) + WINDOW <= ends[of]
    found = np.zeros(len(text), bool)
    with tempfile.TemporaryDirectory() as folder:
        for suffixes, common in induced(text, WINDOW, folder):
            inside = starts[suffixes]
            # Suffixes that end before the window share no window with others.
            fresh = np.flatnonzero(np.r_[True, common[1:] < WINDOW])
            own = np.where(inside, owners[of[np.minimum(suffixes, len(of) - 1)]], np.iinfo(np.int64).max)
            least = np.minimum.reduceat(own, fresh)
            least = np.repeat(least, np.diff(np.r_[fresh, len(suffixes)]))
            found[suffixes[inside & (least < own)]] = True
    return found[starts]


KIND = Kind(WINDOW, RUN, split, len, judge)


def _finish(rows: pd.DataFrame, texts: list[bytes], covered: list[np.ndarray]) -> pd.DataFrame:
    found = []
    for text, gone in zip(texts, covered, strict=True):
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (len(gone) > 0 and gone[0]))
        found.append((len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    out = pd.DataFrame(found, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])
    out.insert(0, "doc_id", rows["doc_id"].astype("Int64").array)
    return out


def removed_strings(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of every row."""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return find(docs, KIND, _finish, schema)


def _rewrite(rows: pd.DataFrame, texts: list[bytes], covered: list[np.ndarray]) -> pd.DataFrame:
    """Texts without characters all of whose bytes are covered."""
    kept = []
    for body, text, gone in zip(rows["body"], texts, covered, strict=True):
        data = np.frombuffer(text, np.uint8)
        if gone.any():
            first = np.flatnonzero((data & 0xC0) != 0x80)
            whole = np.logical_and.reduceat(gone, first)
            gone = np.repeat(whole, np.diff(np.r_[first, len(data)]))
            text = data[~gone].tobytes()
        kept.append(None if body is None else text.decode("utf-8", "replace"))
    return pd.DataFrame({"text": pd.Series(kept, dtype=object), "was": pd.Series([bool(t.strip()) for t in texts], dtype=bool)})


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated strings cut out of their texts (whole characters only).  Documents of
    which nothing is left go; ``n_chars``, if there, is counted anew; all other columns stay as they are."""
    others = docs.drop("text")
    packed = docs.select("doc_id", "text", F.struct(*columns_of(others)).alias("rest"))
    schema = T.StructType().add("rest", others.schema).add("text", T.StringType()).add("was", T.BooleanType())
    found = find(packed, KIND, _rewrite, schema, "rest")
    columns = {name: F.col("rest").getField(name) for name in others.columns}
    columns["text"] = F.col("text")
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.char_length("text").cast(kind)
    left = found.where(~F.col("was") | (F.trim("text") != "") | F.col("text").isNull())
    return left.select(*[columns[name].alias(name) for name in docs.columns])


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed_strings(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {"op7_suffix_dedup": op7_suffix_dedup}
ORACLES: dict[str, str] = {}
