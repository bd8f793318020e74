"""Mined phrases against plain counting, and the trie against a Counter."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from shardloom.llm import collocations as c
from tests.llm.fixtures import as_set, clashing, documents, odd_rows


def by_force(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 6):
                f[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        candidates = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        found = []
        longer = defaultdict(int)
        for g, a in candidates.items():
            for m in range(2, len(g)):
                for i in range(len(g) - m + 1):
                    longer[g[i : i + m]] = max(longer[g[i : i + m]], a)
        for g, a in candidates.items():
            inside = 100 * longer[g] >= 100 * a
            if not inside:
                cuts = [(1000 * a * n[lang] // (counts[g[:k]] * counts[g[k:]]), k) for k in range(1, len(g))]
                score, k = min(cuts)
                found.append((-score, -a, " ".join(g).encode(), counts[g[:k]], counts[g[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def some_rows():
    rng = np.random.default_rng(8)
    words = ["a", "b", "the", "New", "York", "city", "é", "x\x01y", "日本", "z-1"]
    rows = []
    for i in range(150):
        parts = [str(rng.choice([*words, "new york city", "the end of a", "a a a"], p=None)) + str(rng.choice([" ", "  ", "\t", ". ", "\n"], p=[0.7, 0.1, 0.1, 0.05, 0.05])) for _ in range(rng.integers(0, 60))]
        rows.append((i, "".join(parts), [None, "en", "fr"][i % 3], "s", None))
    return rows + odd_rows()


@pytest.mark.parametrize(
    "options",
    [{}, {"block_words": 300, "part_windows": 40, "burst": 4, "full": 50}, {"part_windows": 4, "top": 7}],
)
def test_mining(spark, options):
    rows = some_rows()
    top = options.get("top", 2000)
    found = c.mine(clashing(documents(spark, rows).repartition(3)), least=5, **options)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    expected = by_force(rows, 5, top)
    assert as_set(found) == sorted(expected, key=repr) and len(expected) > 10


def test_empty_table_and_rare_phrases(spark):
    assert c.mine(documents(spark, [])).count() == 0
    assert c.mine(documents(spark)).where("lang = 'fr'").count() == 0


@given(st.lists(st.lists(st.integers(0, 400), max_size=30), max_size=20), st.sampled_from([4, 8]), st.integers(0, 6), st.integers(1, 60))
def test_trie(texts, unit, burst, full):
    """Runs add up to the windows, each run is sorted, bursts and spills lose nothing."""
    ids = np.array([x for text in texts for x in [*text, 0]], np.int64)
    windows = c.windows_of(ids, unit)
    trie, found = c.HatTrie(unit, burst, full), Counter()
    runs = [run for i in range(0, len(windows), 25) for run in trie.add(windows[i : i + 25])]
    for rows, counts in [*runs, *trie.spill()]:
        listed = [tuple(row) for row in rows.tolist()]
        assert listed == sorted(set(listed))
        again, n = c.unpacked_run(c.packed_run(rows, counts), unit)
        assert again.tolist() == rows.tolist() and n.tolist() == counts.tolist()
        found.update(dict(zip(listed, counts.tolist(), strict=True)))
    expected = Counter()
    for text in texts:
        for piece in _pieces(text):
            expected.update(tuple([*piece[i : i + 5], 0, 0, 0, 0][:5]) for i in range(len(piece) - 1))
    assert found == expected and trie.entries == 0 and not trie.roots


def _pieces(text):
    out = [[]]
    for x in text:
        out = [*out, []] if x == 0 else [*out[:-1], [*out[-1], x]]
    return out


def test_windows_of_one_prefix_meet():
    rows = np.array([[2, 4, 1, 0, 0], [2, 9, 9, 9, 9], [3, 5, 6, 1, 0], [3, 5, 6, 8, 8], [3, 5, 0, 0, 0]], ">u4")
    parts = c.prefix_parts(rows, 1 << 30)
    assert parts[0] == parts[1] and parts[2] == parts[3] and len(set(parts.tolist())) == 3
