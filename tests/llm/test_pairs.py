"""Test items in documents, and nearest vectors, against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardloom.llm import decontaminate, neighbours
from tests.llm.fixtures import SENTENCE, as_set, clashing, documents


def found_by_force(docs, items, words=5, percent=80):
    def shingles(text, n):
        w = (text or "").encode().lower().split()
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    best = {}
    for doc_id, text, *_ in docs:
        for item_id, item in items:
            span = min(words, len((item or "").encode().split()))
            of = shingles(item, span) if span else set()
            n = len(of & shingles(text, span)) if of else 0
            if None not in (doc_id, item_id) and of and n * 100 >= percent * len(of):
                best[doc_id, item_id] = max(best.get((doc_id, item_id), (0, 0, 0)), (n / len(of), len(of), n))
    return sorted((*k, n, m, c) for k, (c, n, m) in best.items())


ITEMS = [(1, SENTENCE), (2, SENTENCE + " indeed"), (3, "too short"), (4, None), (None, SENTENCE), (5, " ".join(f"W{i}" for i in range(300, 360))), (1, "other words of an item that repeats an id"), (6, "Lazy dog"), (7, "WORD"), (8, "old oak  tree and"), (9, " "), (10, "w7 w8 w10")]


@pytest.mark.parametrize("empty", ["none", "docs", "items"])
def test_items_found(spark, empty):
    rows = [] if empty == "docs" else None
    docs = documents(spark, rows)
    items = spark.createDataFrame([] if empty == "items" else ITEMS, "item_id long, text string")
    found = decontaminate.find_items(clashing(docs), clashing(items))
    expected = found_by_force([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert as_set(found) == sorted(expected, key=repr)
    assert empty != "none" or {r[0] for r in expected} >= {4, 5, 6, 8}
    kept = decontaminate.without_items(clashing(docs), items)
    assert kept.columns == clashing(docs).columns
    dirty = {r[0] for r in expected}
    judged = [(r["doc_id"] or 0, r["text"]) for r in docs.collect()]
    clean = sorted(i for i, text in judged if not (i in dirty or (i == 0 and text == SENTENCE and dirty)))
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == clean


def test_each_row_is_judged_by_its_own_text(spark):
    rows = [(1, SENTENCE, None, None, None), (1, "a clean text", None, None, None), (None, SENTENCE, None, None, None), (None, None, None, None, None)]
    items = spark.createDataFrame([(1, SENTENCE)], "item_id long, text string")
    kept = decontaminate.without_items(documents(spark, rows), items)
    assert as_set(kept.select("doc_id", "text")) == [(1, "a clean text"), (None, None)]


def test_a_text_is_split_once_per_pass(spark, capsys):
    """A filter pushed below the split would have every shingle split its text again."""
    docs, items = documents(spark), spark.createDataFrame(ITEMS, "item_id long, text string")
    known = decontaminate.item_shingles(items)
    for plan in (decontaminate.candidates(decontaminate._texts(docs), known), decontaminate.contained(docs, items)):
        plan.explain("extended")
        text = capsys.readouterr().out
        optimized = text[text.index("== Optimized Logical Plan ==") : text.index("== Physical Plan ==")]
        assert optimized.count("split(") == 1
        assert optimized.count("array_intersect(") <= 1


def test_long_texts_take_time_in_proportion(spark):
    """40,000 words in a few seconds: shingling that grows with the square takes hours."""
    import time

    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    took = {}
    for n in (1_000, 1_000, 40_000):
        text = " ".join(f"w{i}" for i in range(n))
        docs = documents(spark, [(i, f"{i} {text}", None, None, None) for i in range(8)])
        began = time.perf_counter()
        assert {r["item_id"] for r in decontaminate.find_items(docs, items).collect()} >= {5}
        took[n] = time.perf_counter() - began
    assert took[40_000] < 40 * max(took[1_000], 0.5)


def test_partial_items_of_every_size(spark):
    """Documents that lack just so many, and one more, of an item's shingles."""
    docs, items = [], []
    for k, n in enumerate((5, 6, 9, 12, 20, 31, 40, 64, 100)):
        words = [f"i{k}w{j}" for j in range(n)]
        items.append((k, " ".join(words)))
        shingles = n - 4
        for lacks in range(0, shingles + 1):
            docs.append((k * 1000 + lacks, "before " + " ".join(words[lacks:]) + " after", None, None, None))
    found = decontaminate.find_items(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    assert as_set(found) == sorted(found_by_force(docs, items), key=repr)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def nearest_by_force(rows, k=20):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v, _ in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    dims = max((len(v) for _, v in good), default=0)
    good = [(i, np.pad(v, (0, dims - len(v)))) for i, v in good]
    out = []
    for q, v in good:
        if q % 20 == 0:
            best = {}
            for i, x in good:
                if i != q:
                    best[i] = max(best.get(i, -np.inf), float(np.einsum("ij,j->i", x[None], v)[0]))
            ranked = sorted(best.items(), key=lambda p: (-p[1], p[0]))[:k]
            out += [(q, r, i, s) for r, (i, s) in enumerate(ranked, 1)]
    return sorted(set(out))


def test_odd_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist(), 0) for i in range(40)]
    same = rows[3][1]
    rows += [(100 + i, same, 0) for i in range(45)]
    rows += [(200, None, 0), (201, [], 0), (202, [0.0] * 6, 0), (203, [1.0, None], 0), (204, [float("nan"), 1.0], 0),
             (205, [float("inf"), 1.0], 0), (206, [3.0, 4.0], 0), (None, [1.0] * 6, 0), (7, rows[7][1], 0)]
    found = as_set(neighbours.nearest(clashing(vectors(spark, rows)), F.col("vec_id") % 20 == 0))
    expected = nearest_by_force(rows)
    assert [(q, r, i) for q, r, i, _ in sorted(found)] == [(q, r, i) for q, r, i, _ in expected]
    assert np.allclose([x[3] for x in sorted(found)], [x[3] for x in expected], rtol=1e-12)


def test_few_vectors_and_none(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [0.5, 0.5], 0), (2, [-1.0, 0.0], 0)]
    found = as_set(neighbours.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0))
    assert found == [(0, 1, 1, 0.5), (0, 2, 2, -1.0)]
    assert neighbours.nearest(vectors(spark, []), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("bucket", [1024, 8])
def test_recall_on_random_vectors(spark, monkeypatch, bucket):
    """Unit vectors without structure are the hardest; small buckets add the second polytope."""
    monkeypatch.setattr(neighbours, "BUCKET", bucket)
    monkeypatch.setattr(neighbours, "PART", 100)
    x = np.random.default_rng(2).normal(size=(4000, 32))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    found = neighbours.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0).collect()
    expected = {(q, i) for q, _, i, _ in nearest_by_force([r for r in rows if r[0] % 20 == 0] + [r for r in rows if r[0] % 20])}
    hit = {(r["query_id"], r["vec_id"]) for r in found} & expected
    assert len(hit) / len(expected) >= 0.9


def test_longer_vectors_win_by_inner_product(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=8) * rng.uniform(0.1, 10)).tolist(), 0) for i in range(1500)]
    found = neighbours.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0).collect()
    expected = {(q, i) for q, _, i, _ in nearest_by_force(rows)}
    assert len({(r["query_id"], r["vec_id"]) for r in found} & expected) / len(expected) >= 0.9


@pytest.mark.parametrize("lengths", ["outlier", "lognormal"])
def test_recall_where_lengths_differ(spark, lengths):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(20_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if lengths == "outlier":
        x[1] *= 10
    else:
        x *= rng.lognormal(size=(len(x), 1))
    x = x.astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    found = neighbours.nearest(vectors(spark, rows), F.col("vec_id") % 100 == 0).collect()
    queries = np.arange(0, len(x), 100)
    scores = x[queries].astype(float) @ x.T.astype(float)
    scores[np.arange(len(queries)), queries] = -np.inf
    best = np.argpartition(-scores, 20, axis=1)[:, :20]
    expected = {(int(q), int(i)) for q, ids in zip(queries, best, strict=True) for i in ids}
    assert len(found) == len(expected)
    assert len({(r["query_id"], r["vec_id"]) for r in found} & expected) / len(expected) >= 0.9


def test_queries_that_meet_too_few_are_compared_with_all(spark):
    rng = np.random.default_rng(8)
    rows = [(i, (v / np.linalg.norm(v)).tolist(), 0) for i, v in enumerate(rng.normal(size=(30, 64)) * 0.01 + np.eye(64)[0])]
    rows[0] = (0, [-x for x in rows[0][1]], 0)
    found = neighbours.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, tables=1, probes=1)
    of_first = [tuple(x)[:3] for x in sorted(found.collect()) if x[0] == 0]
    assert of_first == [x[:3] for x in nearest_by_force(rows) if x[0] == 0]


def test_hadamard_is_orthonormal():
    h = neighbours.hadamard(np.eye(16))
    assert np.allclose(h @ h.T, np.eye(16))
