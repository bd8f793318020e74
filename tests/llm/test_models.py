"""Language, toxicity and quality: held-out accuracy, odd rows, and the parts on their own."""

import itertools
import math
import zlib

import numpy as np
import pytest

from shardloom.llm import langid, quality, toxicity
from tests.llm.fixtures import as_set, clashing, documents, in_folder

SF = "/root/testdata/sf0.01"


def test_forward_sums_over_all_segmentations():
    numbers = {piece: i for i, piece in enumerate(["▁", "a", "b", "ab", "▁a", "bb", "abb"])}
    pieces = langid.Pieces(numbers)
    rng = np.random.default_rng(0)
    p = rng.random((2, pieces.size + 1))
    words = ["▁abb", "▁ab", "bé", "▁", "abab"]
    lattice = langid.Lattice(words, pieces)
    total = lattice.total(lattice.forward(p))

    def by_force(word, row):
        n, sums = len(word), 0.0
        for cuts in itertools.product([0, 1], repeat=n - 1):
            at = [0, *[i + 1 for i, c in enumerate(cuts) if c], n]
            parts = [word[i:j] for i, j in itertools.pairwise(at)]
            value = 1.0
            for part in parts:
                if part in numbers:
                    value *= row[numbers[part]]
                elif len(part) == 1:
                    value *= row[pieces.size]
                else:
                    value = 0.0
            sums += value
        return sums

    expected = [[by_force(word, row) for word in words] for row in p]
    assert np.allclose(total, expected)
    # Every piece that is used covers its letters: expected lengths add up to those of the words.
    counts = lattice.expected(p, np.ones((2, len(words))))
    lengths = np.array([*map(len, numbers), 1])
    assert np.allclose(counts @ lengths, sum(map(len, words)))


def test_language_is_found_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = langid.op9_language(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found)
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.98 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_of_odd_rows(spark):
    docs = clashing(documents(spark))
    rows = [(r["doc_id"], r["text"], r["__lang"]) for r in langid.identify(docs).collect()]
    for _, text, found in rows:
        if not text or not any(map(str.isalpha, text)):
            assert (found["lang_pred"], found["score"]) == ("und", 0.0)
        else:
            assert found["lang_pred"] in ("en", "fr")
    assert langid.keep_identified(docs).columns == docs.columns
    unlabelled = documents(spark, [(1, "some words", None, None, None)])
    assert langid.identify(unlabelled).first()["__lang"].asDict() == {"lang_pred": "und", "score": 0.0}
    assert langid.identify(documents(spark, [])).count() == 0


def test_long_words_are_cut_not_dropped():
    word = "a" * 60
    assert langid.words_of(word) == ["▁" + "a" * 24, "a" * 24, "a" * 12]
    assert langid.words_of("Été-42 x") == ["▁été", "▁x"]


def test_toxicity_on_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = toxicity.op5_toxicity(spark, SF).join(labels, "doc_id").where("held_out").collect()
    toxic = [r for r in found if r["toxic"] == 1]
    clean = [r for r in found if r["toxic"] == 0]
    assert sum(r["predicted"] for r in clean) <= 0.05 * len(clean)
    assert sum(r["predicted"] for r in toxic) >= 0.5 * len(toxic)
    pairs = [(t["score"] > c["score"]) + 0.5 * (t["score"] == c["score"]) for t in toxic for c in clean]
    assert sum(pairs) / len(pairs) >= 0.9


def test_toxicity_of_odd_rows(spark, folder):
    labels = spark.createDataFrame(
        [(4, 0), (6, 1), (7, None), (8, 1), (10, 0), (None, 1), (99, 1), (4, 0)], "doc_id long, toxic int"
    )
    in_folder(folder, documents=clashing(documents(spark)), labels=clashing(labels))
    found = toxicity.op5_toxicity(spark, folder).collect()
    assert len(found) == documents(spark).count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    one = toxicity.score(documents(spark), labels.where("toxic = 1")).collect()
    assert {r["score"] for r in one} == {1.0}
    none = toxicity.score(documents(spark), labels.where("toxic = 7")).collect()
    assert {r["score"] for r in none} == {0.0}
    assert toxicity.score(documents(spark, []), labels).count() == 0


def test_toxic_features():
    names = dict(zip(("words", "density", "hits", "near", "hidden"), toxicity.features("You are an IDIOT, an 1d10t!", frozenset({"idiot"})), strict=False))
    assert names["hits"] == 1 and names["hidden"] == 1 and names["near"] > 0
    assert toxicity.features(None, frozenset()) == toxicity.features("", frozenset())


def test_accuracies_of_labellers_are_recovered():
    """Votes drawn from known rates: the posteriors tell the classes apart."""
    rng = np.random.default_rng(5)
    good = rng.random(20_000) < 0.85
    patterns, right = {}, {}
    for is_good in good:
        rate = 0.03 if is_good else 0.6
        name = "".join("-" if rng.random() < rate else "+" if rng.random() < 0.7 else "0" for _ in range(6))
        patterns[name] = patterns.get(name, 0) + 1
        right.setdefault(name, []).append(is_good)
    posterior = quality.fit_votes(patterns)
    hit = sum(sum(g == (posterior[name] >= 0.5) for g in found) for name, found in right.items())
    assert hit / len(good) >= 0.96
    assert all(0 <= p <= 1 and math.isfinite(p) for p in posterior.values())
    assert quality.fit_votes({}) == {}


def test_quality_agrees_with_labels_it_never_saw(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = quality.op8_quality(spark, SF).join(labels, "doc_id").collect()
    good = [r for r in found if r["quality"] == 1]
    bad = [r for r in found if r["quality"] == 0]
    assert sum(r["keep"] for r in good) >= 0.97 * len(good)
    assert sum(not r["keep"] for r in bad) >= 0.6 * len(bad)


@pytest.mark.parametrize("rows", [None, []], ids=["odd", "empty"])
def test_quality_of_odd_rows(spark, rows):
    docs = documents(spark, rows)
    found = as_set(quality.classify(clashing(docs)))
    assert len(found) == docs.count()
    assert all(0 <= score <= 1 and keep == (score >= 0.5) for _, _, _, score, keep in found)


@pytest.mark.parametrize("text", ["", "Ab c\t1!", "\x1c\x1f X", "Éa ß\u2003Ⅷ日 ²"])
def test_kinds_of_characters(text):
    assert quality._kinds(text) == tuple(sum(map(test, text)) for test in (str.isalpha, str.isspace, str.isupper))


def test_only_letters_have_a_language():
    assert langid.words_of("² ½ ③ 12") == [] and langid.words_of("a²b Çé") == ["▁a", "▁b", "▁çé"]
