"""Byte-level BPE encoding and decoding through a global shuffle of distinct words.

The pattern of the vocabulary cuts a text into words (pre-tokens).  A task writes its texts as
blocks: every word of a block once, and the places of the words as numbers (see ``blocks``).  The
words of a block are dealt by hash to buckets of words and shuffled, packed with their numbers: one row
per block and bucket.  A bucket has all occurrences of its words, so each distinct word of all
documents is encoded once, by merging the pair of lowest rank until none is left; the ids go back to the
blocks that asked, and are put in order by place.  Ids are decoded by a map-side join with the table of
token bytes, which is as large as the vocabulary whatever the data.

A bucket is read as a stream, and holds the distinct words of about ``BUCKET_BYTES`` of text.  A word
that occurs everywhere costs its bucket one number per block, not one per occurrence.  Blocks are
shuffled once and read twice, for their words and for their places.  They are a function of the rows of a
task in their order; should a lost block ever be made again from another order, the stamp that its words
carry tells, and the job fails.

What is a letter, a number or white space beyond ASCII is what the installed ``tiktoken`` takes for
one: it is asked once per character, as other libraries go by other versions of Unicode.

Defined results: null texts are empty; empty texts have no token and decode to nothing; very long
texts are encoded whole; each row gives a row, repeated rows and rows without an id too; of two pairs
of equal rank the left one is merged first; an empty table gives an empty result.  Other columns are
ignored.  Special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import heapq
import re
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.llm.blocks import Numbers, by_frequency, from_varints, gather, varints
from shardloom.llm.common import Query, read, text_bytes
from shardloom.llm.grams import word_hashes

VOCABULARY = "byte_bpe_50k.tiktoken"

#: Words after which a block is closed, words whose places are resolved at a time, and bytes of text
#: per bucket of words.
BLOCK_WORDS = 1 << 21
CHUNK = 1 << 18
BUCKET_BYTES = 4 << 20

BLOCKS = "block bigint, data binary"
PIECES = "block bigint, bucket bigint, stamp bigint, words binary"
ANSWERS = "block bigint, stamp bigint, ids binary"
ENCODED = "doc_id bigint, ids array<int>"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def public_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: pairs are merged by rank, the leftmost of the lowest first."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    n = len(word)
    ends = list(range(1, n + 1))  # a part begins at its index
    before = list(range(-1, n - 1))
    heap = [(rank, i) for i in range(n - 1) if (rank := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        rank, left = heapq.heappop(heap)
        right = ends[left]
        if right <= left or right >= n or ranks.get(word[left : ends[right]]) != rank:
            continue  # one of the two was merged since
        end = ends[left] = ends[right]
        ends[right] = -1
        if end < n:
            before[end] = left
            if (next_rank := ranks.get(word[left : ends[end]])) is not None:
                heapq.heappush(heap, (next_rank, left))
        if (first := before[left]) >= 0 and (next_rank := ranks.get(word[first:end])) is not None:
            heapq.heappush(heap, (next_rank, first))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[word[at : ends[at]]])
        at = ends[at]
    return ids


class Splitter:
    """Words of a text by a pattern of literals, ``\\s``, ``\\p{L}`` and ``\\p{N}``.

    Matching is done on ASCII: any other character is replaced by one of its kind that no literal of the
    pattern has, and the words are cut out of the text at the same places.
    """

    #: A letter, a number, another character and white space other than a space.  A
    #: character is of the first kind with which it forms one word.
    STAND_INS = ("x", "1", "!", "\n")

    def __init__(self, pattern: str) -> None:
        self.pattern = pattern
        own = pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\sA-Za-z0-9]").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")
        self.find = re.compile(own, re.ASCII).findall
        self.asked: dict[int, str] = {}

    def ask(self, characters: list[str]) -> None:
        import tiktoken

        ranks = {bytes([i]): i for i in range(256)}
        for character in characters:
            for lead in self.STAND_INS:
                word = (lead + character).encode()
                for end in range(2, len(word) + 1):
                    ranks.setdefault(word[:end], len(ranks))
        known = tiktoken.Encoding("kinds", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        for character in characters:
            kinds = [lead for lead in self.STAND_INS if len(known.encode_ordinary(lead + character)) == 1]
            self.asked[ord(character)] = kinds[0]

    def words(self, text: str) -> list[str]:
        if text.isascii():
            return self.find(text)
        if new := [c for c in set(text) if c > "\x7f" and ord(c) not in self.asked]:
            self.ask(new)
        ends = list(accumulate(map(len, self.find(text.translate(self.asked)))))
        return [text[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def packed(*parts: bytes) -> bytes:
    sizes, _ = varints(np.array([len(part) for part in parts]))
    return zstandard.ZstdCompressor(level=3).compress(bytes([len(sizes)]) + sizes + b"".join(parts))


def unpacked(data: bytes) -> list[bytes]:
    data = zstandard.ZstdDecompressor().decompress(data)
    at = 1 + data[0]
    parts = []
    for size in from_varints(data[1:at]).tolist():
        parts.append(data[at : at + size])
        at += size
    return parts


def _blocks(pattern: str, block_words: int):
    schema = pa.schema([("block", pa.int64()), ("data", pa.binary())])

    def close(number: int, index: Numbers, ids: list, texts: list[np.ndarray]) -> pa.RecordBatch:
        codes = np.concatenate(texts)
        order, new = by_frequency(codes, len(index))
        every = list(index)
        words = [every[i].encode() for i in order]
        missing = np.array([i is None for i in ids], np.uint8)
        data = packed(
            np.array([i or 0 for i in ids], np.int64).tobytes(),
            missing.tobytes(),
            varints(np.array([len(text) for text in texts]))[0],
            varints(new[codes])[0],
            varints(np.array([len(word) for word in words]))[0],
            b"".join(words),
        )
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([data], pa.binary())], schema=schema)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Splitter(pattern)
        number = TaskContext.get().partitionId() << 32
        index, ids, texts, size = Numbers(), [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids.append(doc_id.as_py())
                texts.append(index.of(split.words(text.as_py() or "")))
                size += len(texts[-1])
                if size >= block_words:
                    yield close(number, index, ids, texts)
                    number += 1
                    index, ids, texts, size = Numbers(), [], [], 0
        if ids:
            yield close(number, index, ids, texts)

    return blocks


def _stamp(sizes: bytes, letters: bytes) -> int:
    return zlib.crc32(letters, zlib.crc32(sizes))


def _pieces(buckets: int):
    """The words of a block by bucket: their numbers (as gaps), their sizes, their bytes."""

    def pieces(block: pd.DataFrame) -> pd.DataFrame:
        *_, packed_sizes, letters = unpacked(block["data"].iloc[0])
        sizes = from_varints(packed_sizes)
        ends = sizes.cumsum()
        starts, data = ends - sizes, np.frombuffer(letters, np.uint8)
        bucket = (word_hashes(data, starts, ends) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bounds = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0, True]) if len(sizes) else np.zeros(1, np.int64)
        rows = []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            own = order[a:b]
            words = packed(varints(np.diff(own, prepend=0))[0], varints(sizes[own])[0], gather(data, sizes, own).tobytes())
            rows.append((bucket[own[0]], words))
        out = pd.DataFrame(rows, columns=["bucket", "words"])
        out.insert(0, "stamp", _stamp(packed_sizes, letters))
        out.insert(0, "block", block["block"].iloc[0])
        return out

    return pieces


def encode_words(pieces: DataFrame, path: str) -> DataFrame:
    """``(block, stamp, words)`` to ``(block, stamp, ids)``: every distinct word encoded once, in its bucket."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranks, bucket, known = ranks_of(path), None, {}
        for batch in batches:
            out = []
            for own, data in zip(batch["bucket"], batch["words"], strict=True):
                if own != bucket:
                    bucket, known = own, {}
                numbers, sizes, letters = unpacked(data)
                ends = from_varints(sizes).cumsum().tolist()
                words = [letters[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
                for word in words:
                    if word not in known:
                        known[word] = merged(word, ranks)
                ids = [known[word] for word in words]
                flat = np.array([i for x in ids for i in x], np.int64)
                out.append(packed(numbers, varints(np.array([len(x) for x in ids]))[0], varints(flat)[0]))
            yield pd.DataFrame({"block": batch["block"], "stamp": batch["stamp"], "ids": out})

    dealt = pieces.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInPandas(encode, ANSWERS)


def _in_place(block: pd.DataFrame, words: pd.DataFrame, path: str | None) -> pd.DataFrame:
    """Ids of the texts of one block; with the table at ``path``, also the bytes they stand for."""
    doc_ids, missing, text_sizes, codes, word_sizes, letters = unpacked(block["data"].iloc[0])
    if (words["stamp"] != _stamp(word_sizes, letters)).any():
        raise ValueError("a block was made again from rows in another order: write the input to a table first")
    found = [[from_varints(part) for part in unpacked(data)] for data in words["ids"]]
    none = np.zeros(0, np.int32)
    order = np.argsort(np.concatenate([none, *[gaps.cumsum() for gaps, _, _ in found]]))
    n_ids, ids = (np.concatenate([none, *[x[k] for x in found]]) for k in (1, 2))
    ids, n_ids = gather(ids, n_ids, order), n_ids[order]
    codes = from_varints(codes)
    flat = np.concatenate([none, *[gather(ids, n_ids, codes[i : i + CHUNK]) for i in range(0, len(codes), CHUNK)]])
    ends = np.r_[0, n_ids[codes].cumsum()][from_varints(text_sizes).cumsum()]
    texts = [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    known = pd.arrays.IntegerArray(np.frombuffer(doc_ids, np.int64).copy(), np.frombuffer(missing, bool).copy())
    out = pd.DataFrame({"doc_id": known, "ids": texts})
    if path is not None:
        tokens = Tokens(path)
        out["decoded"] = [tokens.joined(ids) for ids in texts]
    return out


def encode(
    docs: DataFrame, path: str | None = None, pattern: str | None = None,
    block_words: int = BLOCK_WORDS, bucket_bytes: int = BUCKET_BYTES, decoded: bool = False,
) -> DataFrame:
    """``(doc_id, ids)``: the token ids of every row of ``docs``; with ``decoded``, what ``decode`` makes of
    them is added by the same task."""
    path, pattern = path or vocabulary_path(), pattern or public_pattern()
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    buckets = 1 + text_bytes(texts) // bucket_bytes
    by_block = texts.mapInArrow(_blocks(pattern, block_words), BLOCKS).groupBy("block")
    words = encode_words(by_block.applyInPandas(_pieces(buckets), PIECES), path)
    table = path if decoded else None
    return by_block.cogroup(words.groupBy("block")).applyInPandas(
        lambda left, right: _in_place(left, right, table), ENCODED + (", decoded binary" if decoded else "")
    )


class Tokens:
    """The table of token bytes, to be joined with ids."""

    def __init__(self, path: str) -> None:
        tokens = {rank: token for token, rank in ranks_of(path).items()}
        self.sizes = np.zeros(max(tokens) + 1, np.int64)
        self.known = np.zeros(len(self.sizes), bool)
        self.known[list(tokens)] = True
        self.sizes[list(tokens)] = [len(token) for token in tokens.values()]
        self.letters = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(len(self.sizes))), np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        unknown = (ids < 0) | (ids >= len(self.sizes))
        unknown[~unknown] = ~self.known[ids[~unknown]]
        if unknown.any():
            raise ValueError(f"no token has the id {ids[unknown][0]}")
        parts = [gather(self.letters, self.sizes, ids[i : i + CHUNK]) for i in range(0, len(ids), CHUNK)]
        return b"".join(part.tobytes() for part in parts)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded``: the bytes that each row's ``ids`` stand for; none for null.

    Each task joins its ids with the table of token bytes.  An id that the table lacks fails the job.
    """
    path = path or vocabulary_path()

    @F.pandas_udf("binary")
    def bytes_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = Tokens(path)
        for batch in batches:
            yield batch.map(lambda ids: tokens.joined(np.asarray([] if ids is None else ids, np.int64)), na_action=None)

    return encoded.withColumn("decoded", bytes_of("ids"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids_text = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encode(read(spark, sf_dir, "documents"), decoded=True).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids_text.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Query] = {"op13_bpe": op13_bpe}
ORACLES: dict[str, str] = {}
