import re
import json
from pathlib import Path

import pytest
from murmur import routing_hash
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import shardloom as sl
from shardloom.operators.conform import StrictMappingError
from shardloom.plans.restore import MissingManifestError
from shardloom.plans.scratch import scratch_dir
from shardloom.plans.write import DuplicateIdError, write_configured

NOTES = {"properties": {"text": {"type": "text"}, "number": {"type": "long"}}}
ENTRIES = {"properties": {"rank": {"type": "long"}, "heading": {"type": "text"}, "body": {"type": "text"}}}


def notes(spark, count=1000):
    return spark.range(count).select(
        F.concat(F.lit("id"), "id").alias("_id"),
        F.concat(F.lit("note "), "id").alias("text"),
        F.col("id").alias("number"),
    )


def written(df, folder, mapping=NOTES, shards=2, **options):
    result = sl.write_snapshot(df, folder, "test", mapping, shards, **options)
    return sl.open_snapshot(df.sparkSession, result.path)


def stored_files(snapshot):
    return list(Path(snapshot.path).glob("docs/shard=*/part=*/*.parquet"))


def test_json_lines_end_to_end(spark, folder):
    """1,000 JSON lines, two shards: written, restored, searched."""
    lines = [json.dumps({"_id": f"id{i}", "text": f"note {i}", "number": i}) for i in range(1000)]
    (Path(folder) / "input.jsonl").write_text("\n".join(lines) + "\n")
    config = sl.resolve_config(
        spark, output_dir=f"{folder}/out", index_name="test", mapping=NOTES, num_shards=2
    )
    result = sl.write_jsonl_snapshot(spark, f"{folder}/input.jsonl", config)
    snapshot = sl.open_snapshot(spark, result.path)

    metadata = snapshot.index_metadata().collect()
    assert len(metadata) == 1 and metadata[0]["generation"] == 0
    assert metadata[0]["num_routing_shards"] == sl.num_routing_shards(2) == 1024
    assert snapshot.total_hits().first().asDict() == {"value": 1000, "relation": "eq"}
    assert snapshot.shards_summary().first().asDict() == {
        "total": 2, "successful": 2, "skipped": 0, "failed": 0,
    }
    assert [r["doc_count"] for r in snapshot.manifest().orderBy("shard").collect()] == [495, 505]  # fixed values of the routing
    assert snapshot.match_all().count() == 10
    restored = snapshot.documents().select("_id", "fields.*").collect()
    assert {(r["_id"], r["text"], r["number"]) for r in restored} == {
        (f"id{i}", f"note {i}", i) for i in range(1000)
    }


def test_rows_end_to_end(spark, folder):
    df = spark.range(1, 10001).select(
        F.concat(F.lit("id"), "id").alias("_id"),
        F.col("id").alias("rank"),
        F.concat(F.lit("entry no. "), "id").alias("heading"),
        F.concat(F.lit("body of "), "id").alias("body"),
    )
    snapshot = written(df, folder, ENTRIES)
    assert snapshot.total_hits().first()["value"] == 10000
    assert [r["doc_count"] for r in snapshot.manifest().orderBy("shard").collect()] == [5011, 4989]  # fixed values of the routing
    hits = snapshot.match_all().collect()
    assert [h["_id"] for h in hits] == sorted(
        f"id{i}" for i in range(1, 10001) if routing_hash(f"id{i}") % 1024 < 512
    )[:10]
    number = int(hits[0]["_id"][2:])
    assert hits[0]["_index"] == "test" and hits[0]["_score"] == 1.0
    assert json.loads(hits[0]["_source"]) == {
        "rank": number, "heading": f"entry no. {number}", "body": f"body of {number}",
    }


def test_custom_id_of_json_lines_must_be_declared(spark, folder):
    (Path(folder) / "input.jsonl").write_text('{"number":7,"text":"x"}\n')
    settings = {"output_dir": f"{folder}/out", "index_name": "test", "num_shards": 2}
    config = sl.resolve_config(spark, mapping=NOTES, id_field="number", **settings)
    result = sl.write_jsonl_snapshot(spark, f"{folder}/input.jsonl", config)
    row = sl.restore(spark, result.path).first()
    assert row["_id"] == "7" and row["fields"]["number"] == 7
    only_text = {"properties": {"text": {"type": "text"}}}
    config = sl.resolve_config(spark, mapping=only_text, id_field="number", **settings)
    with pytest.raises(PySparkException, match="undeclared fields number"):
        sl.write_jsonl_snapshot(spark, f"{folder}/input.jsonl", config)


def test_path_holds_job_and_index(spark, folder):
    result = sl.write_snapshot(notes(spark, 3), folder, "test", NOTES, 2, job_id="job_7")
    assert result.path == f"{folder}/job_7/test"
    generated = sl.write_snapshot(notes(spark, 3), folder, "test", NOTES, 2)
    assert generated.job_id.startswith("job_2") and generated.job_id != "job_7"


def test_existing_target_fails_before_any_work(spark, folder):
    written(notes(spark, 3), folder, job_id="j")
    broken = spark.range(1).selectExpr(
        "raise_error('job ran') as _id", "'x' as text", "id as number"
    )
    with pytest.raises(FileExistsError, match="already exists"):
        written(broken, folder, job_id="j")


@pytest.mark.parametrize(
    ("options", "message"),
    [
        ({"num_shards": 0}, ">= 1"), ({"num_shards": "2"}, "integer"), ({"index_name": ""}, "index name"),
        ({"index_name": "a/b"}, "index name"), ({"mapping": ""}, "mapping missing"),
        ({"output_path": ""}, "output directory missing"),
    ],
)
def test_settings_are_checked(spark, folder, options, message):
    arguments = {
        "output_path": folder, "index_name": "test", "mapping": NOTES, "num_shards": 2, **options,
    }
    with pytest.raises(ValueError, match=message):
        sl.write_snapshot(notes(spark, 1), **arguments)


def test_write_from_configuration(spark, folder):
    config = sl.resolve_config(
        spark, output_dir=folder, index_name="test", mapping=NOTES, num_shards=3, id_field="key"
    )
    result = write_configured(notes(spark, 10).withColumnRenamed("_id", "key"), config)
    manifest = sl.read_manifest(spark, result.path)
    assert {(r["num_shards"], r["id_field"]) for r in manifest.collect()} == {(3, "key")}


def test_empty_shards_are_in_the_manifest(spark, folder):
    snapshot = written(notes(spark, 3), folder, shards=16)
    rows = snapshot.manifest().collect()
    assert sorted(r["shard"] for r in rows) == list(range(16))
    assert sum(r["doc_count"] for r in rows) == 3
    assert snapshot.shards_summary().first()["successful"] == 16


def test_no_documents_at_all(spark, folder):
    snapshot = written(notes(spark, 0), folder)
    assert snapshot.total_hits().first()["value"] == 0
    assert snapshot.match_all().collect() == []
    assert snapshot.documents().collect() == []
    assert snapshot.shards_summary().first()["successful"] == 2
    snapshot.write_search_tables("text")
    assert snapshot.match("text", "note").collect() == []


def test_missing_manifest(spark, folder):
    with pytest.raises(MissingManifestError, match="did the job that writes it complete"):
        sl.open_snapshot(spark, folder)


def test_failed_write_is_no_snapshot(spark, folder):
    df = spark.createDataFrame([("a", "x", "1"), ("b", "y", "q")], "_id string, text string, number string")
    with pytest.raises(PySparkException, match="document b does not fit the mapping in number"):
        sl.write_snapshot(df, folder, "test", NOTES, 2, job_id="j")
    with pytest.raises(MissingManifestError):
        sl.open_snapshot(spark, f"{folder}/j/test")


def test_undeclared_column_fails(spark, folder):
    with pytest.raises(StrictMappingError, match="undeclared fields extra"):
        written(notes(spark, 1).withColumn("extra", F.lit(1)), folder)


def test_undeclared_json_field_fails_even_if_all_fields_are_text(spark, folder):
    docs = spark.createDataFrame([("a", '{"text":"x","z":1}')], "_id string, source string")
    with pytest.raises(PySparkException, match="document a has undeclared fields z"):
        sl.write_documents(docs, folder, "test", {"properties": {"text": {"type": "text"}}}, 2)


@pytest.mark.parametrize("as_json", [False, True])
def test_null_id_fails(spark, folder, as_json):
    rows = spark.createDataFrame([(None, "x", 1)], "_id string, text string, number int")
    with pytest.raises(PySparkException, match="missing id field _id"):
        if as_json:
            docs = rows.select("_id", F.lit("{}").alias("source"))
            sl.write_documents(docs, folder, "test", NOTES, 2)
        else:
            written(rows, folder)


def test_id_column_must_exist(spark, folder):
    with pytest.raises(ValueError, match="id field key is not a column"):
        written(notes(spark, 1), folder, id_field="key")


def test_number_ids(spark, folder):
    df = spark.range(50).selectExpr("id", "'t' as text", "id as number")
    snapshot = written(df, folder, id_field="id")
    assert {r["_id"] for r in snapshot.documents().collect()} == {str(i) for i in range(50)}
    assert snapshot.verify_routing().count() == 0


def test_duplicates_fail_without_an_order(spark, folder):
    df = notes(spark, 20).union(notes(spark, 3))
    with pytest.raises(DuplicateIdError, match=r"not unique, for example id\d: pass order_by"):
        sl.write_snapshot(df, folder, "test", NOTES, 2, job_id="j")
    with pytest.raises(MissingManifestError):
        sl.open_snapshot(spark, f"{folder}/j/test")


def test_newest_duplicate_wins(spark, folder):
    later = notes(spark, 20).select("_id", "text", (F.col("number") + 100).alias("number"))
    snapshot = written(later.union(notes(spark, 50)), folder, order_by="number")
    stored = {r["_id"]: r["number"] for r in snapshot.documents().select("_id", "fields.number").collect()}
    assert stored == {f"id{i}": i + 100 if i < 20 else i for i in range(50)}


def test_newest_duplicate_wins_for_json(spark, folder):
    docs = sl.documents_from_dataframe(
        notes(spark, 5).union(notes(spark, 5).select("_id", "text", (F.col("number") + 9)))
    )
    order = F.get_json_object("source", "$.number").cast("int")
    result = sl.write_documents(docs, folder, "test", NOTES, 2, order_by=order)
    stored = sl.restore(spark, result.path).select("_id", "fields.number").collect()
    assert {r["_id"]: r["number"] for r in stored} == {f"id{i}": i + 9 for i in range(5)}


def test_one_hot_id(spark, folder):
    """A third of all rows has one id."""
    hot = spark.range(30000).selectExpr(
        "if(id % 3 = 0, 'hot', 'id' || id) as _id", "'t' as text", "id as number"
    )
    snapshot = written(hot, folder, order_by="number", shards=4)
    assert snapshot.total_hits().first()["value"] == 20001
    kept = snapshot.documents().where("_id = 'hot'").select("fields.number").first()
    assert kept["number"] == 29997


def test_result_does_not_depend_on_the_partitions_of_the_input(spark, folder):
    df = notes(spark, 500)
    results = [
        sorted(written(df.repartition(n), folder, shards=3).documents().collect(), key=str)
        for n in (1, 7)
    ]
    assert results[0] == results[1]


def test_stored_files(spark, folder):
    snapshot = written(notes(spark), folder)
    files = stored_files(snapshot)
    assert {f.parent.parent.name for f in files} == {"shard=0", "shard=1"}
    assert len(files) <= 2 * 8
    for file in files:
        ids = [r["_id"] for r in spark.read.parquet(str(file)).select("_id").collect()]
        assert ids == sorted(ids)
    assert spark.read.parquet(str(files[0])).select("fields.*").columns == ["number"]


def test_large_shards_are_cut(spark, folder):
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        snapshot = written(notes(spark, 20000).repartition(16), folder, shards=1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(stored_files(snapshot)) == 24
    assert snapshot.total_hits().first()["value"] == 20000


def test_write_has_one_shuffle_and_no_python(spark, folder, monkeypatch):
    from pyspark.sql import DataFrameWriter

    plans = []
    parquet = DataFrameWriter.parquet

    def spy(self, path, *args, **kwargs):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return parquet(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    written(notes(spark, 10), folder)
    assert len(plans) == 1
    assert plans[0].count("Exchange") == 1 and "REPARTITION_BY_COL" in plans[0]
    assert "Python" not in plans[0]
    exchange = plans[0].index("Exchange")
    assert plans[0].index("StructsToJsonEvaluator") < exchange


def test_maps_and_arrays_are_checked_by_value(spark, folder):
    mapping = {"properties": {"m": {"properties": {"a": {"type": "long"}}}}}
    good = spark.sql("select 'x' as _id, map('a', 1) as m")
    stored = written(good, folder, mapping).documents().select("fields.m.a").collect()
    assert [r["a"] for r in stored] == [1]
    bad = spark.sql("select 'x' as _id, map('b', 1) as m")
    with pytest.raises(PySparkException, match="undeclared fields m.b"):
        written(bad, folder, mapping)


def test_nulls_stay_in_the_source(spark, folder):
    df = spark.sql("select 'x' as _id, string(null) as text, bigint(null) as number")
    row = written(df, folder).documents().first()
    assert row["source"] == '{"text":null,"number":null}'
    assert row["fields"].asDict() == {"number": None, "text": None}


def test_declared_fields_may_be_missing(spark, folder):
    df = spark.sql("select 'x' as _id, 'only' as text")
    row = written(df, folder).documents().first()
    assert row["source"] == '{"text":"only"}'
    assert row["fields"].asDict() == {"number": None, "text": "only"}


@pytest.mark.parametrize("as_json", [False, True])
def test_odd_field_names(spark, folder, as_json):
    mapping = {
        "properties": {
            "a.b": {"type": "long"}, "shard": {"type": "long"}, "it's `x`": {"type": "text"},
            "source": {"properties": {"_id": {"type": "keyword"}, "c d": {"type": "date"}}},
        }
    }
    df = spark.sql(
        "select 'k' as _id, 1 as `a.b`, 7 as shard, 'Some text' as `it's ``x```, "
        "named_struct('_id', 'inner', 'c d', timestamp'2024-01-02 03:04:05Z') as source"
    )
    if as_json:
        docs = sl.documents_from_dataframe(df)
        result = sl.write_documents(docs, folder, "test", mapping, 2)
        snapshot = sl.open_snapshot(spark, result.path)
    else:
        snapshot = written(df, folder, mapping)
    row = snapshot.documents().select("_id", "shard", "fields").first()
    fields = row["fields"].asDict(recursive=True)
    assert row["_id"] == "k" and row["shard"] in (0, 1)
    assert fields.pop("source")["_id"] == "inner"
    assert fields == {"a": {"b": 1}, "shard": 7, "it's `x`": "Some text"}
    snapshot.write_search_tables()
    assert [h["_id"] for h in snapshot.match("it's `x`", "TEXT").collect()] == ["k"]


def test_hook_makes_the_documents(spark, folder):
    def to_document(df):
        return sl.documents_from_dataframe(df.selectExpr("id as _id", "'made' as text"))

    snapshot = written(spark.range(4), folder, to_document=to_document)
    assert {r["text"] for r in snapshot.documents().select("fields.text").collect()} == {"made"}


def test_typed_filters_reach_the_files(spark, folder):
    docs = written(notes(spark), folder).documents().where("fields.number > 990").select("_id")
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(fields.number,990)" in plan and "from_json" not in plan
    assert docs.count() == 9


def test_ids_of_a_page_stay_out_of_the_plan(spark, folder, monkeypatch):
    df = spark.range(40).select(F.col("id").cast("string").alias("id"), F.lit("x").alias("a"))
    written = sl.write_snapshot(df, folder, "i", {"properties": {"a": {"type": "keyword"}}}, num_shards=2, id_field="id")
    monkeypatch.setattr(type(df), "toArrow", None)
    page = sl.open_snapshot(spark, written.path).match_all(30)
    assert "_id#" in (plan := page._jdf.queryExecution().optimizedPlan().toString())
    assert not re.search(r"_id#\d+ (IN|INSET) ", plan)
    assert page.count() == 30


def test_match_all_reads_only_the_shards_it_needs(spark, folder):
    snapshot = written(notes(spark), folder, shards=8)
    plan = snapshot.match_all(5)._jdf.queryExecution().optimizedPlan().toString()
    assert "shard" in plan
    assert snapshot.match_all(5).count() == 5
    assert snapshot.match_all(2000).count() == 1000
    everything = [r["_id"] for r in snapshot.match_all(1000).collect()]
    by_shard = snapshot.documents().orderBy("shard", "_id").select("_id").collect()
    assert everything == [r["_id"] for r in by_shard]


def test_pages_of_any_size(spark, folder):
    snapshot = written(notes(spark), folder, shards=3)
    snapshot.write_search_tables("text")
    for size in (1, 40, 999):
        hits, found = snapshot.match_all(size).collect(), snapshot.match("text", "note", size).collect()
        assert len(hits) == len(found) == size
        assert [h["_id"] for h in found] == sorted(f"id{i}" for i in range(1000))[:size]


def test_part_of_a_frequent_term_is_cut(spark, folder):
    """Each document holds the same word; its postings are split over several files."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    try:
        snapshot = written(notes(spark, 20000).repartition(16), folder, shards=1)
        snapshot.write_search_tables("text")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    post = snapshot.postings("text").where("term = 'note'")
    assert post.count() == 20000
    assert post.select(F.input_file_name()).distinct().count() > 1
    assert len(snapshot.match("text", "note 77").collect()) == 10
    assert snapshot.match("text", "note 77").first()["_id"] == "id77"


def test_shards_summary_sees_lost_files(spark, folder):
    snapshot = written(notes(spark, 40), folder)
    extra = spark.createDataFrame([("stray", "{}", (1,))], "_id string, source string, fields struct<number: bigint>")
    extra.write.mode("append").parquet(f"{snapshot.path}/docs/shard=1/part=0")
    summary = sl.open_snapshot(spark, snapshot.path).shards_summary().first()
    assert (summary["successful"], summary["failed"]) == (1, 1)


def test_shards_summary_sees_changed_rows(spark, folder):
    """As many rows as before, but one of them has another source."""
    snapshot = written(notes(spark, 40), folder)
    assert snapshot.shards_summary(contents=True).first()["failed"] == 0
    file = stored_files(snapshot)[0]
    rows = spark.read.parquet(str(file)).collect()
    changed = spark.createDataFrame([rows[0].asDict() | {"source": "{}"}, *[r.asDict() for r in rows[1:]]], spark.read.parquet(str(file)).schema)
    file.unlink()
    changed.coalesce(1).write.mode("append").parquet(str(file.parent))
    again = sl.open_snapshot(spark, snapshot.path)
    assert again.shards_summary().first()["failed"] == 0
    assert again.shards_summary(contents=True).first()["failed"] == 1


def rows_read(df):
    """Rows that the scans of documents give, after the query has run."""
    rows = df.collect()

    def scans(plan):
        leaves = plan.collectLeaves()
        for i in range(leaves.size()):
            leaf = leaves.apply(i)
            name = leaf.nodeName()
            if "QueryStage" in name:
                yield from scans(leaf.plan())
            elif "parquet" in name and "source#" in leaf.toString():
                yield leaf.metrics().apply("numOutputRows").value()

    plan = df._jdf.queryExecution().executedPlan()
    return len(rows), list(scans(plan.executedPlan() if "Adaptive" in plan.nodeName() else plan))


def test_pages_read_in_proportion_to_their_hits(spark, folder):
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.page.row.count.limit", "500")
    try:
        snapshot = written(notes(spark, 200_000), folder, shards=2)
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.page.row.count.limit")
    for size in (10, 11, 20, 1000, 3000):
        hits, read = rows_read(snapshot.match_all(size))
        assert hits == size and sum(read) <= max(8 * 500, 3 * size), (size, read)
    snapshot.write_search_tables("text")
    for size in (10, 11, 20):
        hits, read = rows_read(snapshot.match("text", "note", size))
        assert hits == size and len(read) == 1 and read[0] <= 1000 * size, (size, read)


def test_page_ends_within_a_shard(spark, folder):
    snapshot = written(notes(spark, 3000), folder, shards=3)
    expected = [r["_id"] for r in snapshot.documents().orderBy("shard", "_id").select("_id").collect()]
    counts = [r["doc_count"] for r in snapshot.manifest().orderBy("shard").collect()]
    for size in (0, 1, counts[0] - 1, counts[0], counts[0] + 1, 1001, 2999, 3000, 9999):
        assert [r["_id"] for r in snapshot.match_all(size).collect()] == expected[:size], size


def test_mapping_is_restored_as_strict(spark, folder):
    snapshot = written(notes(spark, 1), folder, mapping={"_doc": NOTES})
    row = snapshot.get_mapping().first()
    assert row["index_name"] == "test"
    assert json.loads(row["mapping"]) == {"_doc": {**NOTES, "dynamic": "strict"}}


def test_scratch_is_in_the_shared_folder(spark):
    assert scratch_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_texts_over_the_parsers_usual_limit(spark, folder):
    df = spark.range(2).selectExpr("concat('id', id) as _id", "concat(repeat('ab ', 8500000), 'needle') as text")
    snapshot = written(df, folder, {"properties": {"text": {"type": "text"}}})
    assert [r[0] for r in snapshot.documents().selectExpr("length(fields.text)").collect()] == [25_500_006] * 2
