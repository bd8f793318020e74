"""Find windows that also start in a document with a smaller id: what substring operators share.

A window is ``window`` consecutive units (words or bytes) of one document.  Its anchor is the least
hash of the runs of ``run`` units inside it, so equal windows have equal anchors.  Neighbouring
windows mostly have the same anchor; such a stretch of windows is a piece.

1. Documents are dealt to batches of about ``BATCH_BYTES``, by a hash of id and text, so an id that
   many rows have, or that they lack, fills no batch alone.  Every batch sends
   the anchors it has, as 4-byte hashes, to buckets; a bucket answers which ones more than one
   document has, and which ones are hot: their distinct pieces, summed over the batches, would
   overfill a block.
2. Batches send the pieces whose anchors are shared to blocks, by the anchor: all equal windows meet
   in one block.  Pieces of hot anchors are cut into single windows, which go by the hash of the
   whole window; equal windows still meet, and no block gets all of a frequent run.  A batch sends equal pieces once, for its smallest id; in its other documents they
   are known to repeat.  So a passage that any share of documents has comes to its block once for
   each batch.
3. A block finds the windows of its pieces that also occur under a smaller id.  How is up to the
   operator.
4. Batches apply the answers.

All three uses of the batches read one shuffle of the texts.  Only shared stretches travel again,
compressed.  Everything is a function of the rows, so lost tasks can run again.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardloom.llm.common import release_memory, text_bytes
from shardloom.llm.grams import mix, run_hashes, sliding_min

#: Bytes of text in a batch, in the share of a block, and in an array operation.
BATCH_BYTES = 8 << 20
BLOCK_BYTES = 4 << 20
CHUNK_BYTES = 1 << 20

#: Anchors in a bucket, about.
BUCKET_ANCHORS = 2_000_000

NO_ID = np.iinfo(np.int64).max


@dataclass
class Units:
    """Units of some texts: a hash and the text (by number) of each."""

    hashes: np.ndarray
    row: np.ndarray
    #: Bytes of units ``start`` to ``stop`` of all.
    content: Callable[[int, int], bytes]


@dataclass(frozen=True)
class Kind:
    """What units are, and how a block solves its pieces.

    ``solve(contents, owners)`` takes distinct contents and the smallest id of each, ascending, and
    returns a flag for each window of each content, in order.
    """

    window: int
    run: int
    split: Callable[[list[bytes]], Units]
    count: Callable[[bytes], int]
    solve: Callable[[list[bytes], np.ndarray], np.ndarray]


@dataclass
class Pieces:
    """Stretches of windows with one anchor: text, first and last window in it, anchor, and the
    place among all units."""

    row: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    at: np.ndarray
    units: Units
    #: Bytes of a unit, on average.
    unit_bytes: float


def pieces(kind: Kind, texts: list[bytes]) -> Iterator[Pieces]:
    """Pieces of ``texts``, some texts at a time."""
    begin = 0
    while begin < len(texts):
        end, size = begin, 0
        while end < len(texts) and (end == begin or size + len(texts[end]) <= CHUNK_BYTES):
            size += len(texts[end])
            end += 1
        units = kind.split(texts[begin:end])
        least = sliding_min(run_hashes(units.hashes, kind.run), kind.window - kind.run + 1)
        if len(least):
            row = units.row
            valid = row[: len(least)] == row[kind.window - 1 :]
            same = valid[1:] & valid[:-1] & (least[1:] == least[:-1])
            start = np.flatnonzero(valid & ~np.r_[False, same])
            stop = np.flatnonzero(valid & ~np.r_[same, False])
            offset = np.searchsorted(row, row[start])
            yield Pieces(row[start] + begin, start - offset, stop - offset, least[start], start, units, size / len(units.hashes))
        begin = end


def _pack(*values) -> bytes:
    return zstandard.compress(pickle.dumps(values, protocol=5), 3)


def _unpack(data: bytes) -> tuple:
    return pickle.loads(zstandard.decompress(data))


def _ordered(batch: pd.DataFrame) -> tuple[pd.DataFrame, list[bytes], np.ndarray]:
    """Rows of a batch by id, then text; their texts; their ids, missing ones last."""
    ids = batch["doc_id"].astype("Int64").fillna(NO_ID).to_numpy(np.int64)
    texts = [text if text is not None else b"" for text in batch["body"]]
    order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
    return batch.iloc[order], [texts[i] for i in order], ids[order]


def _cells(values: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Positions of each of 0 to n-1 that occurs in ``values``."""
    order = np.argsort(values, kind="stable")
    bounds = np.searchsorted(values[order], np.arange(n + 1))
    for cell in np.flatnonzero(np.diff(bounds)):
        yield int(cell), order[bounds[cell] : bounds[cell + 1]]


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among ``known``, which is sorted."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _joined(row: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches of windows, touching ones made one."""
    order = np.lexsort((first, row))
    row, first, last = row[order], first[order], last[order]
    touch = (row[1:] == row[:-1]) & (first[1:] <= last[:-1] + 1)
    begin = np.flatnonzero(np.r_[True, ~touch])[: len(row)]
    return (row[begin], first[begin], np.maximum.reduceat(last, begin)) if len(row) else (row, first, last)


def find(
    docs: DataFrame,
    kind: Kind,
    finish: Callable[[pd.DataFrame, list[bytes], list[np.ndarray]], pd.DataFrame],
    schema: str | T.StructType,
    carried: str | None = None,
) -> DataFrame:
    """Apply ``finish`` to the rows of each batch, their texts as bytes, and for each text a flag for
    every unit: covered by a repeated window.  The column ``carried`` comes first in ``schema`` and goes
    along as it is."""
    size = text_bytes(docs)
    n_batches = max(1, -(-size // BATCH_BYTES))
    n_buckets = max(16, -(-size // (16 * BUCKET_ANCHORS)))
    n_blocks = max(16, -(-size // BLOCK_BYTES))
    # What batches do not report is as much again at most.
    hot_bytes = BLOCK_BYTES / 2

    def key(anchor: np.ndarray) -> np.ndarray:
        return (anchor % np.uint64(n_buckets) << np.uint64(32)) | (anchor >> np.uint64(32))

    def anchors(batch: pd.DataFrame) -> pd.DataFrame:
        release_memory()  # of the batch before, or of another stage
        _, texts, _ = _ordered(batch)
        found = []
        for p in pieces(kind, texts):
            whole, span = run_hashes(p.units.hashes, kind.window), p.last - p.first
            name = mix(whole[p.at] + mix(whole[p.at + span] + span.astype(np.uint64)))
            found.append((key(p.anchor), p.row, name, (span + kind.window) * p.unit_bytes))
        rows = []
        if found:
            anchor, row, name, weight = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((name, anchor))
            anchor, row, name, weight = anchor[order], row[order], name[order], weight[order]
            fresh = np.r_[True, (anchor[1:] != anchor[:-1]) | (name[1:] != name[:-1])]
            first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
            many = np.minimum.reduceat(row, first) != np.maximum.reduceat(row, first)
            own, total = anchor[first], np.add.reduceat(np.where(fresh, weight, 0.0), first)
            for bucket, at in _cells((own >> np.uint64(32)).astype(np.int64), n_buckets):
                own_at, many_at = own[at].astype(np.uint32), many[at]
                large = total[at] > hot_bytes / n_batches
                rows.append((
                    bucket, own_at[~many_at].tobytes(), own_at[many_at].tobytes(), own_at[large].tobytes(),
                    total[at][large].tobytes(),
                ))
        out = pd.DataFrame(rows, columns=["bucket", "once", "often", "large", "bytes"])
        out.insert(1, "from_batch", batch["batch"].iloc[0])
        return out

    def shared(bucket: pd.DataFrame) -> pd.DataFrame:
        release_memory()
        once = [np.frombuffer(x, np.uint32) for x in bucket["once"]]
        often = [np.frombuffer(x, np.uint32) for x in bucket["often"]]
        every = np.sort(np.concatenate([*once, *often]))
        twice = np.unique(np.concatenate([every[1:][every[1:] == every[:-1]], *often]))
        large, of = np.unique(
            np.concatenate([np.frombuffer(x, np.uint32) for x in bucket["large"]]), return_inverse=True
        )
        total = np.bincount(of, np.concatenate([np.frombuffer(x) for x in bucket["bytes"]]), len(large))
        hot = large[total > hot_bytes].tobytes()
        rows = []
        for batch, a, b in zip(bucket["from_batch"], once, often, strict=True):
            answer = np.r_[a[_among(a, twice)], b]
            if len(answer):
                rows.append((batch, bucket["bucket"].iloc[0], answer.tobytes(), hot))
        return pd.DataFrame(rows, columns=["to_batch", "bucket", "answer", "hot"])

    def send(batch: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"block": [], "from_batch": [], "known": [], "data": []})
        if not len(batch) or not len(answers):
            return empty
        release_memory()
        number = int(batch["batch"].iloc[0])
        live, hot = (
            np.sort(
                np.concatenate(
                    [
                        (np.uint64(bucket) << np.uint64(32)) | np.frombuffer(answer, np.uint32)
                        for bucket, answer in zip(answers["bucket"], answers[column], strict=True)
                    ]
                )
            )
            for column in ("answer", "hot")
        )
        _, texts, ids = _ordered(batch)
        contents: dict[bytes, int] = {}
        owner, block, uses, known = [], [], [], []
        for p in pieces(kind, texts):
            own = key(p.anchor)
            chosen = np.flatnonzero(_among(own, live))
            spans, deal_by = p.last[chosen] - p.first[chosen], p.anchor[chosen]
            firsts, places = p.first[chosen], p.at[chosen]
            split_up = _among(own[chosen], hot)
            if split_up.any():
                times = np.where(split_up, spans + 1, 1)
                of = np.repeat(np.arange(len(chosen)), times)
                step = np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times)
                chosen, split_up, firsts, places = chosen[of], split_up[of], firsts[of] + step, places[of] + step
                spans = np.where(split_up, 0, spans[of])
                whole = run_hashes(p.units.hashes, kind.window)
                deal_by = np.where(split_up, whole[places], deal_by[of])
            blocks = mix(deal_by) % np.uint64(n_blocks)
            for row, first, span, place, to in zip(
                p.row[chosen].tolist(), firsts.tolist(), spans.tolist(), places.tolist(), blocks.tolist(),
                strict=True,
            ):
                content = p.units.content(place, place + span + kind.window)
                seen = contents.setdefault(content, len(owner))
                if seen == len(owner):
                    owner.append(int(ids[row]))
                    block.append(to)
                if owner[seen] == ids[row]:
                    uses.append((seen, row, first))
                else:
                    known.append((row, first, first + span))
        rows = []
        if known:
            rows.append((n_blocks + number % n_blocks, True, _pack(*_joined(*np.array(known).T))))
        names = list(contents)
        use = np.array(uses, dtype=np.int64).reshape(-1, 3)
        of_content = np.array(block, dtype=np.int64)
        uses_of = dict(_cells(of_content[use[:, 0]], n_blocks))
        for to, at in _cells(of_content, n_blocks):
            own = use[uses_of[to]]
            own[:, 0] = np.searchsorted(at, own[:, 0])
            rows.append((to, False, _pack([names[i] for i in at], [owner[i] for i in at], own)))
        out = pd.DataFrame(rows, columns=["block", "known", "data"])
        out.insert(1, "from_batch", number)
        return out

    def solve(block: pd.DataFrame) -> pd.DataFrame:
        release_memory()
        rows = []
        contents: dict[bytes, int] = {}
        owner: list[int] = []
        sent = []
        for batch, known, data in zip(block["from_batch"], block["known"], block["data"], strict=True):
            if known:
                rows.append((batch, data))
                continue
            names, owners, use = _unpack(data)
            number = np.empty(len(names), np.int64)
            for i, (name, own) in enumerate(zip(names, owners, strict=True)):
                number[i] = seen = contents.setdefault(name, len(owner))
                if seen == len(owner):
                    owner.append(own)
                elif own < owner[seen]:
                    owner[seen] = own
            sent.append((batch, number, np.array(owners, np.int64), use))
        if sent:
            least, names = np.array(owner, np.int64), list(contents)
            order = np.argsort(least, kind="stable")
            sizes = np.array([kind.count(names[i]) - kind.window + 1 for i in order])
            flags = kind.solve([names[i] for i in order], least[order])
            change = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
            begin = np.r_[0, np.cumsum(sizes)]
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            # Stretches of flags, cut at the bounds of contents.
            spans = defaultdict(list)
            for lo, hi in zip(change[::2].tolist(), change[1::2].tolist(), strict=True):
                c = int(np.searchsorted(begin, lo, side="right")) - 1
                while lo < hi:
                    stop = min(hi, int(begin[c + 1]))
                    spans[c].append((lo - int(begin[c]), stop - 1 - int(begin[c])))
                    lo, c = stop, c + 1
            for batch, number, owners, use in sent:
                found = []
                for local, row, first in use.tolist():
                    c = int(place[number[local]])
                    if owners[local] > least[order[c]]:
                        found.append((row, first, first + int(sizes[c]) - 1))
                    else:
                        found += [(row, first + lo, first + hi) for lo, hi in spans.get(c, ())]
                if found:
                    rows.append((batch, _pack(*_joined(*np.array(found, dtype=np.int64).T))))
        return pd.DataFrame(rows, columns=["to_batch", "data"])

    def apply(batch: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        release_memory()
        ordered, texts, _ = _ordered(batch)
        covered = [np.zeros(kind.count(text) + 1, np.int32) for text in texts]
        for data in answers["data"]:
            for row, first, last in zip(*(x.tolist() for x in _unpack(data)), strict=True):
                covered[row][first] += 1
                covered[row][last + kind.window] -= 1
        return finish(ordered, texts, [np.cumsum(x[:-1]) > 0 for x in covered])

    def apply_carrying(batch: pa.Table, answers: pa.Table) -> pa.Table:
        rows = batch.drop_columns([carried]).to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
        order = _ordered(rows)[0].index.to_numpy()
        found = apply(rows, answers.to_pandas())
        columns = [batch.column(carried).take(pa.array(order)), *[pa.array(found[name], from_pandas=True) for name in found]]
        return pa.table(columns, [carried, *found])

    batches = docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_batches)).alias("batch"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("binary").alias("body"),
        *([] if carried is None else [carried]),
    )
    by_batch = batches.groupBy("batch")
    answers = (
        by_batch.applyInPandas(anchors, "bucket long, from_batch long, once binary, often binary, large binary, bytes binary")
        .groupBy("bucket")
        .applyInPandas(shared, "to_batch long, bucket long, answer binary, hot binary")
    )
    repeated = (
        by_batch.cogroup(answers.groupBy("to_batch"))
        .applyInPandas(send, "block long, from_batch long, known boolean, data binary")
        .groupBy("block")
        .applyInPandas(solve, "to_batch long, data binary")
    )
    last = by_batch.cogroup(repeated.groupBy("to_batch"))
    return last.applyInPandas(apply, schema) if carried is None else last.applyInArrow(apply_carrying, schema)
