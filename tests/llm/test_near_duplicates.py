import numpy as np
import pytest

from shardloom.llm import near_duplicates as nd
from shardloom.llm.components import components
from tests.llm.fixtures import SENTENCE, as_set, clashing, documents, odd_rows


def by_force(rows, words, percent):
    sets = []
    for _, text, *_ in rows:
        w = (text or "").encode().lower().split()
        n = min(words, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    out = []
    for i, (doc_id, *_) in enumerate(rows):
        ids = [r[0] for r, g in zip(rows, group, strict=True) if g == group[i] and r[0] is not None]
        first = min(ids, default=None) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), first, doc_id == first))
    return sorted(out, key=repr)


def variants():
    """Clusters around hidden centres: members are near the centre, not always near each other."""
    rng = np.random.default_rng(11)
    rows = []
    for c in range(4):
        centre = [f"c{c}w{i}" for i in range(120)]
        for k in range(25):
            words = list(centre)
            for at in rng.choice(120, int(rng.integers(0, 7)), replace=False):
                words[at] = f"x{k}"
            rows.append((c * 100 + int(rng.integers(0, 100)), " ".join(words), None, None, None))
    return rows


@pytest.mark.parametrize("rows", [odd_rows(), variants(), []], ids=["odd", "variants", "empty"])
@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_components(spark, rows, words, percent):
    assert as_set(nd.cluster(clashing(documents(spark, rows)), words, percent)) == by_force(rows, words, percent)


@pytest.mark.parametrize("doc_id", [None, 7])
def test_rows_of_one_key_meet_their_own_text_only(spark, doc_id):
    rows = [(doc_id, " ".join(f"t{i}w{j}" for j in range(40)), None, None, None) for i in range(30)]
    docs = documents(spark, rows)
    sketched = nd.sketch(docs, 5)
    keys = sketched.selectExpr("doc_id AS of_id", "text_hash AS of_hash", "node AS of_node")
    assert nd._meeting(nd._keyed(docs), keys).count() == len(rows)
    assert nd._sets(sketched.select("node"), sketched, docs, 5).count() == len(rows)


def test_one_of_each_keeps_columns(spark):
    docs = clashing(documents(spark))
    kept = nd.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 4 in ids and 5 not in ids and None not in ids
    assert {1, 2, 3, 7, 8, 9, 10, 12} <= set(ids)


def test_one_of_each_judges_rows_not_ids(spark):
    clean = "a text that no other document has anything to do with at all"
    rows = [(1, SENTENCE), (2, SENTENCE), (2, clean), (3, clean + " but"), (1, SENTENCE), (None, SENTENCE),
            (None, "only rows without an id have this one"), (None, "only rows without an id have this one"),
            (4, None), (4, None), (5, ""), (None, None)]
    docs = documents(spark, [(i, text, "en", "s", None) for i, text in rows])
    kept = as_set(nd.one_of_each(docs).select("doc_id", "text"))
    expected = [rows[i] for i in (0, 2, 6, 8, 9, 10, 11)]
    assert kept == sorted(expected, key=repr)


def test_all_pairs_within_the_distance_share_a_key(spark):
    distance = nd.distance_for(85)
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 16, nd.COMPONENTS).astype(np.uint16)
    rows = [a]
    for _ in range(200):
        b = a.copy()
        at = rng.choice(nd.COMPONENTS, distance, replace=False)
        b[at] ^= 1
        rows.append(b)
    df = spark.createDataFrame([(bytearray(r.tobytes()),) for r in rows], "s binary")
    keys = [set(r[0]) for r in df.select(nd._keys(df["s"], distance)).collect()]
    assert all(keys[0] & other for other in keys[1:])


def test_long_chains_are_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 300)] + [(1000, 999), (5, 5)], "a long, b long")
    found = {r["node"]: r["root"] for r in components(links).collect()}
    assert found == {i: 0 for i in range(301)} | {999: 999, 1000: 999}
