"""The audit of sources against plain counting."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from shardloom.llm import divergence
from tests.llm.fixtures import as_set, clashing, documents, odd_rows


def terms_of(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)


def by_force(rows, min_docs=10, top=10):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, _ in rows:
        lang, source, terms = lang or "", source or "", terms_of(text)
        groups.add((lang, source))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {lang for lang, _ in groups}:
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        sources = sorted((s for of, s in groups if of == lang), key=str.encode)
        whole = sum((counts[lang, s] for s in sources), Counter())

        def p(count):
            total = sum(count[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 2) // total for t in kept}

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        of = {s: p(counts[lang, s]) for s in sources}
        q = p(whole)
        for s in sources:
            pairs = [(sum(f(of[s][t], of[x][t]) for t in kept), x) for x in sources if x != s]
            terms = [(f(of[s][t], q[t]), t) for t in kept if counts[lang, s][t] and of[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda v: (-v[0], v[1].encode()))
                found = found if part == "pair" else found[:top]
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(found, 1)]
    return sorted(out)


def mixed_rows():
    rng = np.random.default_rng(5)
    words = ["a", "Bc", "éa", "quiteabit", "sixteenletters__", "x" * 16, "y" * 17, "z" * 40, "日本語", "don't", "ABCDEFGH", "abcdefghi"]
    rows = []
    for i in range(160):
        text = " ".join(rng.choice(words, rng.integers(0, 30), p=np.arange(1, 13) / 78)) + rng.choice([".", "!x"])
        rows.append((i, str(text), str(rng.choice(["en", "de", "fr"])), str(rng.choice(["s1", "s2", "S3", "é"])), None))
    return rows + [(i, None, "xx", f"s{i % 3}", None) for i in range(4)] + odd_rows() * 3


@pytest.mark.parametrize("part_counts", [3, divergence.PART_COUNTS])
def test_audit(spark, monkeypatch, part_counts):
    rows = mixed_rows()
    found = divergence.audit(clashing(documents(spark, rows).repartition(4)), part_counts=part_counts)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert as_set(found) == sorted(by_force(rows), key=repr)


def test_empty_table(spark):
    assert divergence.audit(documents(spark, [])).count() == 0


@given(st.lists(st.tuples(st.integers(0, 3), st.text("aB é.ß9", max_size=60)), max_size=12))
def test_counting(rows):
    texts, groups = [text.encode() for _, text in rows], np.array([g for g, _ in rows], np.int64)
    found = {}
    for group, terms, n, docs in divergence.counted(texts, groups):
        for row in zip(group.tolist(), terms.tolist(), n.tolist(), docs.tolist(), strict=True):
            found[row[0], row[1].decode()] = row[2:]
    n, docs = Counter(), Counter()
    for group, text in rows:
        n.update((group, t) for t in terms_of(text))
        docs.update({(group, t) for t in terms_of(text)})
    assert found == {key: (n[key], docs[key]) for key in n}


@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 2**64 - 1)), min_size=1))
def test_radix_order(rows):
    columns = [np.array(c, np.uint64) for c in zip(*rows, strict=True)]
    assert divergence.radix_order(columns).tolist() == sorted(range(len(rows)), key=rows.__getitem__)


@given(st.integers(0, 10**13), st.integers(0, 10**13), st.integers(1, 10**9))
def test_shares_are_exact(count, more, kept):
    total = count + more
    assert divergence.shares(np.array([[count]]), np.array([total]), kept)[0, 0] == 1 + 10**9 * (count + 2) // (total + 2 * kept)
