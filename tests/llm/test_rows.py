"""Mixing, web derivatives and the pipeline."""

import hashlib
import json

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from shardloom.llm import mixing, warc
from tests.llm.fixtures import as_set, clashing, documents


def targets_by_force(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Excess over the cap is shared again by weight until no target is above it."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > most * sizes[s] + 1e-9]
        if not over:
            out |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            out[s] = most * sizes[s]
            open_.discard(s)
        left = share * sum(sizes.values()) - sum(out.values())
    return out


@pytest.mark.parametrize("seed", [0, 1])
def test_mix_meets_targets(spark, seed):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.lit("w "), (F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(40)) + 1).cast("int")).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("source"),
    )
    rows = mixing.mix(docs, seed=seed).join(docs.select("doc_id", "source"), "doc_id").collect()
    assert len(rows) == 3000
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix(docs, seed=seed).join(docs.select("doc_id", "source"), "doc_id").collect()))
    sizes, taken = {}, {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        expected = r["target"] / r["source_size"]
        assert r["taken"] == r["size"] * r["copies"] and r["taken"] <= 2 * r["size"]
        assert int(expected) <= r["copies"] <= int(expected) + 1
    for source, target in targets_by_force(sizes).items():
        assert next(r["target"] for r in rows if r["source"] == source) == pytest.approx(target)
        assert abs(taken[source] - target) <= 41


def test_mix_of_odd_rows(spark):
    found = as_set(mixing.mix(clashing(documents(spark))).select("doc_id", "size", "taken"))
    assert len(found) == documents(spark).count()
    assert {(1, 0, 0), (2, 0, 0), (3, 0, 0)} <= set(found)
    assert mixing.mix(documents(spark, [])).count() == 0


def test_expectations_hold(spark):
    """Over many seeds a document is taken as often as its fraction says."""
    docs = documents(spark, [(i, "w " * (i % 5 + 1), None, "ab"[i % 2], None) for i in range(64)])
    runs = [dict(map(tuple, mixing.mix(docs, seed=s).select("doc_id", "copies").collect())) for s in range(12)]
    expected = {r["doc_id"]: r["target"] / r["source_size"] for r in mixing.mix(docs).collect()}
    for source in (0, 1):
        ids = [i for i in range(64) if i % 2 == source]
        mean = sum(run[i] for run in runs for i in ids) / (len(runs) * len(ids))
        assert mean == pytest.approx(sum(expected[i] for i in ids) / len(ids), abs=0.1)


HTML = """<!DOCTYPE html><html><head><title> A &amp; B
 </title><style>p {}</style></head><body><!-- no --><script>var t="</p>";</script>
<p>One  two</p><P class="x">three &lt;four&gt;</P><a href="/x">link</a><br/>é</body></html>"""


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_derivatives(spark):
    rows = [(1, "http://a/", HTML), (2, None, None), (3, "http://b/", ""), (None, "http://c/", "<script>x"), (1, "http://a/", HTML)]
    responses = warc.responses_from_pages(clashing(pages(spark, rows)))
    sources = {r["record_id"]: r for r in responses.collect()}
    records = warc.derive(clashing(responses), "page_id").collect()
    assert len(records) == 2 * len(rows)
    by_id = {r["record_id"]: r for r in records}
    for r in records:
        source = sources[r["refers_to"]]
        assert by_id[r["concurrent_to"]]["concurrent_to"] == r["record_id"]
        assert r["block_digest"] == "sha256:" + hashlib.sha256(r["block"].encode()).hexdigest()
        assert r["content_length"] == len(r["block"].encode())
        assert r["payload_digest"] == source["warc_headers"]["WARC-Payload-Digest"]
        assert r["payload_digest"] == "sha256:" + hashlib.sha256((source["payload"] or "").encode()).hexdigest()
        if r["warc_type"] == "metadata":
            envelope = json.loads(r["block"])
            assert envelope["source_headers"] == source["warc_headers"]
            assert envelope["http_headers"][0] == "HTTP/1.1 200 OK"
            if r["page_id"] == 1:
                assert envelope["title"] == "A &amp; B" and envelope["links"] == ["/x"]
    text = {r["page_id"]: r["block"] for r in records if r["warc_type"] == "conversion"}
    assert text[1] == "One two\nthree <four>\nlink\né"
    assert text[2] == text[3] == text[None] == ""


def test_links_in_any_quotes(spark):
    html = """<a href="/a b">x</a><A HREF='/c"d'>y</A><a class=z href=/e>z</a><a\thref = "/f"><a href=""><b xhref="no">"""
    found = pages(spark, [(1, "http://a/", html)]).select(warc.links_of(F.col("html")).alias("links")).first()[0]
    assert found == ["/a b", '/c"d', "/e", "/f", ""]


def test_very_long_pages(spark):
    html = "<p>" + "word  &amp; \t word\n\n" * 100_000 + "</p>"
    records = warc.derive(warc.responses_from_pages(pages(spark, [(1, "http://a/", html)]))).collect()
    text = next(r["block"] for r in records if r["warc_type"] == "conversion")
    assert text == "\n".join(["word & word"] * 100_000)


def test_records_as_text(spark):
    records = warc.record_text(warc.derive(warc.responses_from_pages(pages(spark, [(1, "http://a/", HTML)]))))
    for r in records.collect():
        head, _, rest = r["record"].partition("\r\n\r\n")
        headers = dict(line.split(": ", 1) for line in head.split("\r\n")[1:])
        assert head.startswith("WARC/1.1\r\n") and headers["WARC-Refers-To"] == r["refers_to"]
        assert rest.encode()[: int(headers["Content-Length"])].decode() == r["block"]
    assert warc.derive(warc.responses_from_pages(pages(spark, []))).count() == 0


def test_pipeline_stages(spark, folder):
    items = spark.createDataFrame([(1, "a test item that has quite a few words in it indeed")], "item_id long, text string")
    items.write.parquet(f"{folder}/benchmark.parquet")
    plain = [(i, " ".join(f"word{i}x{k}" for k in range(1, 60 + i)), "en", f"s{i % 3}", None) for i in range(1, 30)]
    rows = [
        *plain,
        (100, plain[0][1], "en", "s0", None),
        (101, plain[1][1] + " and one more", "en", "s1", None),
        (102, "before " + items.first()["text"] + " after", "en", "s2", None),
        (103, "123 !!! 456", None, None, None),
        (104, None, None, None, None),
    ]
    docs = clashing(documents(spark, rows))
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), out.schema)
        kept[name] = {r["doc_id"] for r in docs.collect()}
    assert kept["language_id"] == {r[0] for r in rows} - {103, 104}
    assert kept["near_dedup"] == kept["language_id"] - {100, 101}
    assert 102 in kept["suffix_dedup"] and 102 not in kept["decontamination"]
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    mixed = corpus_pipeline.run(spark, folder)
    assert {r["doc_id"] for r in mixed.collect()} == kept["decontamination"]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "suffix_dedup", "decontamination", "mixing"]


def test_pipeline_of_an_empty_table(spark, folder):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    documents(spark, []).write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
