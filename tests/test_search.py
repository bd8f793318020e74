import math
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import shardloom as sl
from shardloom.functions.tokens import query_terms
from shardloom.plans.search_tables import generation_path, read_postings, slices_for, write_postings

TEXTS = {
    "a": "The quick brown fox, the lazy dog.",
    "b": "Fox!",
    "c": "",
    "d": None,
    "e": "  ...  ",
    "f": "été ÉTÉ naïve 42 x_y",
    "g": "dog " * 50 + "fox",
}


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(list(TEXTS.items()), "_id string, text string")
    return sl.with_shard(df, 3)


def test_tokens(docs):
    found = {(r["_id"], r["position"], r["term"]) for r in sl.analyze(docs, "text", "_id").collect()}
    assert found == {(d, i, t) for d, text in TEXTS.items() for i, t in enumerate(tokens(text))}


@pytest.mark.parametrize("text", [t for t in TEXTS.values() if t])
def test_query_terms_follow_the_same_rule(spark, text):
    assert query_terms(spark, text) == list(dict.fromkeys(tokens(text)))


def test_postings(docs):
    expected = {}
    for doc, text in TEXTS.items():
        words = tokens(text)
        for term in set(words):
            places = [i for i, word in enumerate(words) if word == term]
            expected[doc, term] = (len(places), places, len(words))
    rows = sl.postings(docs).collect()
    assert {(r["_id"], r["term"]): (r["tf"], r["positions"], r["doc_len"]) for r in rows} == expected
    assert len(rows) == len(expected)
    shards = {r["_id"]: r["shard"] for r in docs.collect()}
    assert all(r["shard"] == shards[r["_id"]] for r in rows)


def test_postings_need_no_shuffle_and_tokenize_once(docs):
    plan = sl.postings(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert plan.count("split(") == 1


def test_dictionary_and_stats(docs):
    post = sl.postings(docs)
    per_doc = {d: Counter(tokens(t)) for d, t in TEXTS.items() if tokens(t)}
    terms = {t for counts in per_doc.values() for t in counts}
    assert {(r["term"], r["doc_freq"], r["total_tf"]) for r in sl.term_dictionary(post).collect()} == {
        (t, sum(t in c for c in per_doc.values()), sum(c[t] for c in per_doc.values())) for t in terms
    }
    total = sum(sum(c.values()) for c in per_doc.values())
    assert sl.field_stats(post).first().asDict() == {
        "doc_count": len(per_doc), "sum_tokens": total, "avg_len": total / len(per_doc),
    }


def test_stats_of_nothing(docs):
    row = sl.field_stats(sl.postings(docs).where("false")).first()
    assert row.asDict() == {"doc_count": 0, "sum_tokens": 0, "avg_len": 0.0}


def bm25(words):
    per_doc = {d: tokens(t) for d, t in TEXTS.items() if tokens(t)}
    average = sum(map(len, per_doc.values())) / len(per_doc)
    scores = {}
    for doc, own in per_doc.items():
        for word in words:
            tf, df = own.count(word), sum(word in other for other in per_doc.values())
            if tf:
                idf = math.log(1 + (len(per_doc) - df + 0.5) / (df + 0.5))
                share = idf * tf / (tf + 1.2 * (0.25 + 0.75 * len(own) / average))
                scores[doc] = scores.get(doc, 0) + round(share, 6)
    return sorted(((d, round(s, 6)) for d, s in scores.items()), key=lambda x: (-x[1], x[0]))


@pytest.mark.parametrize("words", [["fox"], ["fox", "dog"], ["the", "été", "nothing"], ["nothing"]])
@pytest.mark.parametrize("shards", [1, 5])
def test_match_query(spark, words, shards):
    df = spark.createDataFrame(list(TEXTS.items()), "_id string, text string")
    post = sl.postings(sl.with_shard(df, shards))
    rows = sl.match_query(post, sl.field_stats(post), words).collect()
    assert [(r["_id"], pytest.approx(r["_score"])) for r in rows] == bm25(words)


def test_match_query_has_no_cross_join(docs):
    post = sl.postings(docs)
    best = sl.match_query(post, sl.field_stats(post), ["fox"])
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "TakeOrderedAndProject" in plan


def test_match_query_makes_postings_once(spark, folder):
    import __spark_entry__ as entry

    texts = ["The onesen, the leaux", "verblest", "the", None, "", "other", "other"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df.write.parquet(f"{folder}/documents.parquet")
    best = entry.match_query(spark, folder)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "split(" not in plan
    rows = [(r["_id"], r["_score"]) for r in best.collect()]
    post = sl.postings(sl.with_shard(entry.documents(spark, folder), 3))
    expected = sl.match_query(post, sl.field_stats(post), entry.QUERY_TEXT.split(), 20)
    assert rows == [(r["_id"], r["_score"]) for r in expected.collect()]
    assert [doc for doc, _ in rows] == ["id0", "id1", "id2"]


def test_search_on_stored_tables(spark, folder):
    df = spark.createDataFrame(list(TEXTS.items()), "_id string, body string").withColumn("n", F.lit(1))
    mapping = {"properties": {"body": {"type": "text"}, "n": {"type": "long"}}}
    snapshot = sl.open_snapshot(spark, sl.write_snapshot(df, folder, "test", mapping, 3).path)
    with pytest.raises(FileNotFoundError, match="no search tables for field body"):
        snapshot.match("body", "fox")
    snapshot.write_search_tables()
    hits = snapshot.match("body", "Fox, DOG!").collect()
    assert [(h["_id"], pytest.approx(h["_score"])) for h in hits] == bm25(["fox", "dog"])
    assert hits[0]["_index"] == "test" and '"body":"' in hits[0]["_source"]
    assert snapshot.match("body", "nothing ...").collect() == []
    assert snapshot.match("body", "").collect() == []
    assert len(snapshot.match("body", "fox dog", 2).collect()) == 2
    same = {(r["_id"], r["term"], r["tf"]) for r in snapshot.postings("body").collect()}
    direct = sl.postings(sl.with_shard(df, 3), "body").collect()
    assert same == {(r["_id"], r["term"], r["tf"]) for r in direct}


def test_nested_text_is_searched_by_its_path(spark, folder):
    mapping = {"properties": {"o": {"properties": {"p": {"type": "text"}, "k": {"type": "keyword"}}}}}
    df = spark.sql("select 'x' as _id, struct('Hello there' as p, 'hello' as k) as o")
    snapshot = sl.open_snapshot(spark, sl.write_snapshot(df, folder, "test", mapping, 2).path)
    snapshot.write_search_tables()
    assert [h["_id"] for h in snapshot.match("o.p", "hello").collect()] == ["x"]
    with pytest.raises(ValueError, match="not declared as text fields: o.k"):
        snapshot.write_search_tables("o.k")


def test_slices_follow_the_size_of_the_documents(spark):
    gib = 1 << 30
    assert slices_for(spark, 2, 0) == slices_for(spark, 2, 1000) == 1
    assert slices_for(spark, 2, gib // 4) == 2
    assert slices_for(spark, 2, gib) == slices_for(spark, 2, 1000 * gib) == 4
    assert slices_for(spark, 64, 1000 * gib) == 1


def test_term_lookup_prunes(spark, folder):
    df = spark.range(200).selectExpr(
        "'id' || id as _id", "int(id % 2) as shard", "'w' || id || ' common' as body"
    )
    write_postings(df, folder, "body", 2, slices=3)
    assert {p.name for p in Path(folder).glob("search/body/*/postings/shard=0/*")} == {
        "slice=0", "slice=1", "slice=2",
    }
    post = read_postings(spark, generation_path(spark, folder, "body"), ["w7"], 3)
    plan = post._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*slice#\d+ = \d+", plan)
    assert "EqualTo(term,w7)" in plan
    assert [r["_id"] for r in post.collect()] == ["id7"]
    everything = read_postings(spark, generation_path(spark, folder, "body"))
    assert everything.count() == 400
    assert len(read_postings(spark, generation_path(spark, folder, "body"), ["common", "w1"], 3).collect()) == 201


def test_stored_postings_are_sorted(spark, folder):
    df = spark.range(300).selectExpr(
        "'id' || id as _id", "int(id % 2) as shard", "'b a c ' || id as body"
    )
    write_postings(df, folder, "body", 2)
    for file in Path(folder).glob("search/body/*/postings/shard=*/slice=0/*.parquet"):
        rows = [(r["term"], r["_id"]) for r in spark.read.parquet(str(file)).collect()]
        assert rows == sorted(rows)


def test_tables_can_be_built_again(spark, tmp_path, monkeypatch):
    """A build that fails leaves the tables as they were; a later one replaces them."""
    from shardloom.plans import search_tables

    df = spark.createDataFrame([("a", "one two"), ("b", "two")], "_id string, body string")
    written = sl.write_snapshot(df, str(tmp_path), "i", {"properties": {"body": {"type": "text"}}}, 1)
    snapshot = sl.open_snapshot(spark, written.path)
    with pytest.raises(FileNotFoundError, match="no search tables"):
        snapshot.match("body", "two")
    with monkeypatch.context() as broken:
        broken.setattr(search_tables, "with_average", None)
        with pytest.raises(TypeError):
            snapshot.write_search_tables("body")
    with pytest.raises(FileNotFoundError, match="no search tables"):
        snapshot.match("body", "two")
    snapshot.write_search_tables("body")
    first = search_tables.generation_path(spark, written.path, "body")
    assert [h["_id"] for h in snapshot.match("body", "one two").collect()] == ["a", "b"]
    snapshot.write_search_tables("body")
    assert search_tables.generation_path(spark, written.path, "body") > first
    assert sorted(map(tuple, snapshot.term_dictionary("body").collect())) == [("one", 1, 1), ("two", 2, 2)]


def test_a_match_reads_postings_once(spark, tmp_path):
    df = spark.createDataFrame([("a", "one two"), ("b", "two")], "_id string, body string")
    written = sl.write_snapshot(df, str(tmp_path), "i", {"properties": {"body": {"type": "text"}}}, 1)
    snapshot = sl.open_snapshot(spark, written.path)
    snapshot.write_search_tables("body")
    from shardloom.operators.search import match_query
    from shardloom.plans.search_tables import read_stats, read_terms

    generation = generation_path(spark, written.path, "body")
    best = match_query(read_postings(spark, generation, ["two"]), read_stats(spark, generation), ["two"], 10, read_terms(spark, generation, ["two"]))
    plan = best._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("doc_len") and len([line for line in plan.splitlines() if "Relation" in line and "positions#" in line]) == 1


@pytest.mark.parametrize(
    ("text", "words"),
    [
        ("can't stop", ["can't", "stop"]), ("the 'quick' (brown) fox can’t jump 32.3 feet, right?", ["the", "quick", "brown", "fox", "can’t", "jump", "32.3", "feet", "right"]),
        ("3.14 1,000.5 7:30", ["3.14", "1,000.5", "7", "30"]), ("a.b.c. end.", ["a.b.c", "end"]), ("foo_bar _x_ __", ["foo_bar", "_x_"]),
        ("日本語 ひら カタカナ", ["日", "本", "語", "ひ", "ら", "カタカナ"]), ("e\u0301te\u0301 x", ["e\u0301te\u0301", "x"]),
        ("a1.b 1.a", ["a1", "b", "1", "a"]), ("l'été d’où", ["l'été", "d’où"]), ("", []), ("... !!", []), ("x86-64", ["x86", "64"]),
    ],
)
def test_word_boundaries_of_unicode(spark, text, words):
    df = spark.createDataFrame([("a", text)], "_id string, text string")
    found = sl.analyze(df, "text", "_id", unicode_words=True).orderBy("position").collect()
    assert [r["term"] for r in found] == words
    assert [r["position"] for r in found] == list(range(len(words)))


def test_searches_follow_the_words_of_the_tables(spark, tmp_path):
    df = spark.createDataFrame([("a", "I can't"), ("b", "can t")], "_id string, body string")
    written = sl.write_snapshot(df, str(tmp_path), "i", {"properties": {"body": {"type": "text"}}}, 1)
    snapshot = sl.open_snapshot(spark, written.path)
    snapshot.write_search_tables("body", unicode_words=True)
    assert [h["_id"] for h in snapshot.match("body", "CAN'T").collect()] == ["a"]
    snapshot.write_search_tables("body")
    assert [h["_id"] for h in snapshot.match("body", "CAN'T").collect()] == ["b", "a"]
