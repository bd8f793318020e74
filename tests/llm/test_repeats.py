"""Repeated phrases and strings against brute force; suffix sorting against plain sorting."""

import dataclasses
import hashlib
import tempfile

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shardloom.llm import induced, phrases, repeats, suffixes
from tests.llm.fixtures import as_set, clashing, documents, odd_rows

BIG = 1 << 62


def cover(docs, window, units):
    first = {}
    for doc_id, text in docs:
        parts = units(text)
        for i in range(len(parts) - window + 1):
            key = tuple(parts[i : i + window])
            first[key] = min(first.get(key, BIG + 1), doc_id)
    for doc_id, text in docs:
        parts = units(text)
        gone = np.zeros(len(parts), bool)
        for i in range(len(parts) - window + 1):
            if first[tuple(parts[i : i + window])] < doc_id:
                gone[i : i + window] = True
        yield doc_id, parts, gone


def plain(rows):
    return [(BIG if i is None else i, (text or "").encode()) for i, text, *_ in rows]


def phrases_by_force(rows):
    out = []
    for doc_id, words, gone in cover(plain(rows), 13, bytes.split):
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        doc_id = None if doc_id == BIG else doc_id
        out.append((doc_id, len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def strings_by_force(rows):
    out = []
    for doc_id, data, gone in cover(plain(rows), 50, bytes):
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        doc_id = None if doc_id == BIG else doc_id
        out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def copies():
    """Passages at shifting places, chains of overlaps, runs of one word and of one letter."""
    rng = np.random.default_rng(3)
    pool = [" ".join(rng.choice(["a", "bb", "ccc", "dd", "e"], 60)) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [pool[k][int(rng.integers(0, 40)) :] for k in rng.integers(0, 4, 2)]
        extra = " ".join(rng.choice([f"v{k}" for k in range(50)], int(rng.integers(0, 30))))
        rows.append((int(rng.integers(0, 50)), " ".join([*parts, extra, "zz " * int(rng.integers(0, 40))]), None, None, None))
    return rows


@pytest.mark.parametrize("rows", [odd_rows()[:-1], copies(), []], ids=["odd", "copies", "empty"])
def test_phrases(spark, rows):
    assert as_set(phrases.removed_phrases(clashing(documents(spark, rows)))) == phrases_by_force(rows)


@pytest.mark.parametrize("rows", [odd_rows()[:8] + odd_rows()[9:], copies(), []], ids=["odd", "copies", "empty"])
def test_strings(spark, rows):
    assert as_set(suffixes.removed_strings(clashing(documents(spark, rows)))) == strings_by_force(rows)


def test_many_batches_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BATCH_BYTES", 2_000)
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 1_000)
    rows = copies()
    assert as_set(phrases.removed_phrases(documents(spark, rows))) == phrases_by_force(rows)
    assert as_set(suffixes.removed_strings(documents(spark, rows))) == strings_by_force(rows)


@pytest.mark.parametrize("doc_id", [None, 5])
def test_rows_of_one_id_fill_many_batches(spark, monkeypatch, doc_id):
    monkeypatch.setattr(repeats, "BATCH_BYTES", 2_000)
    shared = " ".join(f"s{j}" for j in range(20))
    rows = [(doc_id, f"{shared} " + " ".join(f"t{i}w{j}" for j in range(40)), None, None, None) for i in range(60)]
    rows.append((1, shared, None, None, None))

    def size(batch, texts, covered):
        return pd.DataFrame({"size": [sum(len(text) for text in texts)]})

    docs = documents(spark, rows)
    sizes = [r["size"] for r in repeats.find(docs, phrases.KIND, size, "size long").collect()]
    assert max(sizes) < sum(sizes) / 3
    assert as_set(phrases.removed_phrases(docs)) == phrases_by_force(rows)
    assert as_set(suffixes.removed_strings(docs)) == strings_by_force(rows)


def test_a_frequent_line_fills_no_block(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BATCH_BYTES", 10_000)
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 2_000)
    line = "all rights reserved by us"
    rows = []
    for i in range(300):
        before, after = ([f"t{i // 2 if i % 50 < 2 else i + 1000}{side}{j}" for j in range(20)] for side in "xy")
        rows.append((i, " ".join([*before, line, *after]), None, None, None))
    docs = documents(spark, rows)
    for module, expected, query in (
        (phrases, phrases_by_force(rows), phrases.removed_phrases),
        (suffixes, strings_by_force(rows), suffixes.removed_strings),
    ):
        kind = module.KIND

        def bounded(contents, owners, solve=kind.solve):
            assert sum(map(len, contents)) <= 20_000
            return solve(contents, owners)

        monkeypatch.setattr(module, "KIND", dataclasses.replace(kind, solve=bounded))
        assert as_set(query(docs)) == expected


def test_texts_are_rewritten_in_whole_characters(spark):
    accents = "é" * 60
    rows = [(1, "start " + accents, "fr", "a", 66), (2, accents + " end", "fr", "a", 64), (3, accents, "fr", "a", 60), (4, None, None, None, None)]
    kept = {r["doc_id"]: r for r in clashing(suffixes.without_repeats(clashing(documents(spark, rows)))).collect()}
    assert sorted(kept) == [1, 2, 4]
    assert kept[1]["text"] == "start " + accents
    assert kept[2]["text"] == " end"
    assert kept[2]["n_chars"] == 4
    assert kept[2]["batch"] == "batch"


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.integers(1, 4), min_size=1, max_size=90),
    st.sampled_from([3, 8, 50]),
    st.sampled_from([0, 1 << 20]),
    st.sampled_from([0, 1024]),
)
def test_induced_sorting(symbols, cap, memory, lanes):
    text = np.array([*symbols, 0])
    before, induced.LANES = induced.LANES, lanes
    with tempfile.TemporaryDirectory() as folder:
        found = list(induced.induced(text, cap, folder, memory))[::-1]
    induced.LANES = before
    order = np.concatenate([a for a, _ in found])
    assert sorted(order) == list(range(len(text)))
    prefixes = [tuple(text[i : i + cap].tolist()) for i in order]
    assert prefixes == sorted(prefixes)
    for suffix, common in found:
        for a, b, n in zip(suffix[:-1], suffix[1:], common[1:], strict=True):
            x, y = text[a : a + cap].tolist(), text[b : b + cap].tolist()
            assert n == next((k for k, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))


def test_factors_need_the_check_at_their_ends():
    """The window across two factors is in the reference, though no factor holds it."""
    words = [f"w{i}" for i in range(40)]
    first = " ".join(words[:16]).encode()
    second = " ".join(words[10:30]).encode()
    both = " ".join(words[:30]).encode()
    flags = phrases.parse([first, second, both], np.array([1, 2, 3]))
    windows = len(words[:16]) - 12 + len(words[10:30]) - 12
    assert flags[:windows].sum() == 0
    assert flags[windows:].tolist() == [i + 13 <= 16 or i >= 10 for i in range(18)]


def test_other_columns_stay_as_they_are(spark):
    text = "x" * 30 + " a passage of more than fifty bytes that two documents have, to be cut out of one "
    rows = [(1, text + "one"), (2, text + "two"), (1 << 60, "three"), (None, "four"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "timestamp'2024-01-02 03:04:05.123456' AS at", "cast(12345678901234567890.123456789 AS decimal(38,9)) AS amount",
        "cast('nan' AS double) AS odd", "cast(null AS int) AS nothing", "array(named_struct('a', 1, 'b', X'00FF')) AS nested",
        "map(1, date'2024-01-01') AS days", "char_length(text) AS n_chars",
    )
    kept = suffixes.without_repeats(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    others = [c for c in docs.columns if c not in ("text", "n_chars", "doc_id")]
    assert {repr(r[1:]) for r in kept.select("doc_id", *others).collect()} == {repr(r[1:]) for r in docs.select("doc_id", *others).collect()}
    found = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    assert found == sorted([(1, text + "one"), (2, "two"), (1 << 60, "three"), (None, "four"), (2, None)], key=repr)


def test_windows_inside_a_factor_are_not_looked_up(monkeypatch):
    """The answer for a long repeated passage comes out of its factor."""
    passage = b" ".join(b"w%d" % i for i in range(1000))
    seen = []
    looked_up = phrases.looked_up
    monkeypatch.setattr(phrases, "looked_up", lambda places, *rest: seen.extend(places.tolist()) or looked_up(places, *rest))
    flags = phrases.parse([passage, b"before " + passage + b" after"], np.array([1, 2]))
    n = 1000 - phrases.WINDOW + 1
    assert flags.tolist() == [False] * n + [False] + [True] * n + [False]
    of_second = [place for place in seen if place >= 1000]
    assert len(of_second) <= 2 * phrases.WINDOW


def test_pieces_alone_with_their_anchor_repeat_nothing():
    """Leaving them out of the sort changes no flag; most pieces of a block need none."""
    rng = np.random.default_rng(5)
    common = rng.integers(97, 123, 300, dtype=np.uint8).tobytes()
    found = []
    for i in range(200):
        own = rng.integers(97, 123, 120, dtype=np.uint8).tobytes()
        begin = int(rng.integers(0, 200))
        found.append(own if i % 4 else own[:60] + common[begin : begin + 100] + own[60:])
    units = [piece for i, text in enumerate(found) for piece in _cut(text, i)]
    contents, owners = zip(*units, strict=True)
    owners = np.array(owners)
    met = suffixes._met(list(contents))
    assert 0 < met.sum() < len(contents) / 2
    flags = suffixes.judge(list(contents), owners)
    assert flags.any()
    assert (flags == suffixes._sorted_out(list(contents), owners)).all()
    assert not len(suffixes.judge([], np.zeros(0, np.int64)))


def _cut(text, owner):
    for p in repeats.pieces(suffixes.KIND, [text]):
        for first, last in zip(p.first.tolist(), p.last.tolist(), strict=True):
            yield text[first : last + suffixes.WINDOW], owner
