"""Byte-level BPE against the installed library, and exact round trips."""

import random

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from shardloom.llm import bpe
from shardloom.llm.blocks import from_varints, gather, varints
from tests.llm.fixtures import as_set, clashing, documents, in_folder, odd_rows

RANKS = bpe.ranks_of(bpe.vocabulary_path())
LIBRARY = tiktoken.Encoding("own", pat_str=bpe.public_pattern(), mergeable_ranks=RANKS, special_tokens={})
SPLIT = bpe.Splitter(bpe.public_pattern())


def by_words(text):
    return [i for word in SPLIT.words(text) for i in bpe.merged(word.encode(), RANKS)]


@settings(max_examples=400, deadline=None)
@given(st.text())
def test_any_text_as_the_library_does(text):
    assert by_words(text) == LIBRARY.encode_ordinary(text)
    assert "".join(SPLIT.words(text)) == text


@pytest.mark.parametrize(
    "text",
    ["", " ", "  a", "a  \n", "I'll we've don't 'S", "x" * 5_000, "ab" * 3_000, "é" * 700, "日本語 テキスト", "a՘b ؀١٢ 　 x",
     "\x1c\x85  ​", "\U0003fc3bq \U0001f600\U0001f600", "<|endoftext|>", "12345  678\t\t9", "!!!??? ...\r\n\r\n"],
)
def test_odd_texts(text):
    assert by_words(text) == LIBRARY.encode_ordinary(text)


def test_characters_of_every_plane():
    """A sample of all code points between letters, digits, marks and blanks."""
    points = random.Random(3).sample([c for c in range(0x110000) if not 0xD800 <= c < 0xE000], 3_000)
    text = "".join(f"{random.Random(c).choice(['a', '1', ' ', '!', ''])}{chr(c)}" for c in points)
    assert by_words(text) == LIBRARY.encode_ordinary(text)


@given(st.lists(st.integers(0, 2**32 - 1)))
def test_numbers_round_trip(codes):
    data, ends = varints(np.array(codes, np.int64))
    assert from_varints(data).tolist() == codes
    assert (ends[-1] if codes else 0) == len(data)


def test_gather():
    assert gather(np.arange(6), np.array([1, 0, 3, 2]), np.array([2, 1, 0, 2])).tolist() == [1, 2, 3, 0, 1, 2, 3]


@pytest.mark.parametrize("sizes", [(1, 4), (50, 100), (bpe.BLOCK_WORDS, bpe.BUCKET_BYTES)])
def test_documents(spark, sizes):
    rows = [*(odd_rows() if sizes[0] > 1 else [r for r in odd_rows() if len(r[1] or "") < 200]), (20, "a\u0558b \U0001f600's", "en", "a", None)]
    docs = documents(spark, rows).repartition(3)
    found = as_set(bpe.decode(bpe.encode(clashing(docs), block_words=sizes[0], bucket_bytes=sizes[1])))
    expected = []
    for doc_id, text, *_ in rows:
        expected.append((doc_id, LIBRARY.encode_ordinary(text or ""), bytearray((text or "").encode())))
    assert found == sorted(expected, key=repr)


def test_query(spark, folder):
    import hashlib

    path = in_folder(folder, documents=documents(spark))
    found = as_set(bpe.op13_bpe(spark, path))
    expected = []
    for doc_id, text, *_ in odd_rows():
        ids = LIBRARY.encode_ordinary(text or "")
        digest = [hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), (text or "").encode())]
        expected.append((doc_id, len(ids), *digest))
    assert found == sorted(expected, key=repr)


def test_empty_table(spark):
    assert bpe.encode(documents(spark, [])).count() == 0


def test_decoding(spark):
    ids = LIBRARY.encode_ordinary("été, où?")
    rows = spark.createDataFrame([(1, ids), (2, []), (3, None), (4, ids[1:2])], "key long, ids array<int>")
    found = {r["key"]: (r["ids"], bytes(r["decoded"])) for r in bpe.decode(rows).collect()}
    assert found == {1: (ids, "été, où?".encode()), 2: ([], b""), 3: (None, b""), 4: (ids[1:2], LIBRARY.decode_bytes(ids[1:2]))}
    for unknown in (10_000_000, -1):
        with pytest.raises(Exception, match=f"no token has the id {unknown}"):
            bpe.decode(spark.createDataFrame([(1, [unknown])], "key long, ids array<int>")).collect()


@given(st.lists(st.binary(max_size=300), max_size=5))
def test_packing(parts):
    assert bpe.unpacked(bpe.packed(*parts)) == parts
