import json
import tempfile
from decimal import Decimal
from pathlib import Path

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import Row
from pyspark.sql import functions as F

import shardloom as sl
from shardloom.operators.documents import without_member, without_member_by_tokens


def jsonl(folder, *lines):
    path = Path(folder) / "in.jsonl"
    path.write_bytes("\n".join(lines).encode())
    return str(path)


def read(spark, folder, *lines, **options):
    docs = sl.read_jsonl_documents(spark, jsonl(folder, *lines), **options).collect()
    return {row["_id"]: json.loads(row["source"]) for row in docs}


def test_blank_lines_are_skipped(spark, folder):
    lines = ["", "   ", "\t", '  {"_id":"a","x":1}\t', "\x00\x1f ", '{"_id":"b","x":2}\r', ""]
    assert read(spark, folder, *lines) == {"a": {"x": 1}, "b": {"x": 2}}


def test_values_survive(spark, folder):
    source = {
        "n": None, "i": 5, "d": 2.5, "t": True, "s": "q\"uo\\te\n日本", "a": [1, "x", None],
        "o": {"p": {"q": []}}, "e": "",
    }
    line = json.dumps({"_id": "a", **source})
    assert read(spark, folder, line) == {"a": source}


@pytest.mark.parametrize(
    ("value", "doc_id"),
    [
        ("5", "5"), ('"x y"', "x y"), ("2.5", "2.5"), ("true", "true"), ('""', ""), ("1.0", "1.0"), ("1e400", "1e400"),
        ("123456789012345678901234567890123456789012345", "123456789012345678901234567890123456789012345"),
        ('"1.0"', "1.0"), ('"q\\"u\\u00e9"', 'q"ué'), ('{"a": 1.0}', '{"a": 1.0}'), ("[1, 2]", "[1, 2]"),
    ],
)
def test_id_becomes_a_string(spark, folder, value, doc_id):
    assert read(spark, folder, '{"_id":%s,"x":1}' % value) == {doc_id: {"x": 1}}


@pytest.mark.parametrize(
    "line",
    [
        '{"_id":"a"}', '{ "_id" : "a" }', '{"_id":"a","x":1.0}', '{"x" : 1e400 , "_id":"a"}', '{"x":1,"_id":"a", "y":[{"_id":2.50}]}',
        '{"x":"_id","_id":"a"}', '{"x":{"_id":"b"},"_id":"a"}', r'{"\u005fid":"a","x":{"_id":3}}', r'{"x":"\"_id\":7,","_id":"a"}',
        '{"_id":"a","x":"a, \\"b\\": {[","n":45678901234567890123456789012345678901234567890.10}', '{"y":{},"_id":"a","z":[]}',
    ],
)
def test_the_id_is_cut_out_and_all_else_stays_as_written(spark, folder, line):
    row = sl.read_jsonl_documents(spark, jsonl(folder, line)).first()
    exact = {"parse_float": Decimal, "parse_int": Decimal}
    expected = json.loads(line, **exact)
    assert row["_id"] == expected.pop("_id") == "a"
    assert json.loads(row["source"], **exact) == expected


def test_both_ways_to_cut_give_the_same(spark, folder):
    lines = ['{"_id":"a"}', '{"_id":"a","x":1}', '{"x":1,"_id":"a"}', '{"x":1, "_id" : 5 , "y":{"z":[1,2]}}', '{"x":1,"_id":null,"y":2}']
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    found = df.select(without_member(F.col("value"), "_id"), without_member_by_tokens(F.col("value"), "_id")).collect()
    for line, (fast, slow) in zip(lines, found, strict=True):
        expected = {k: v for k, v in json.loads(line).items() if k != "_id"}
        assert json.loads(fast) == json.loads(slow) == expected


def test_strings_of_any_length(spark, folder):
    """A string that variants do not hold: read, checked, stored, restored; on both paths."""
    mapping = {"properties": {"x": {"type": "text"}, "k": {"type": "keyword"}, "n": {"type": "long"}}}
    long = "ab" * 10_500_000
    line = json.dumps({"_id": "a", "x": long, "k": "k" + long, "n": 3})
    docs = sl.read_jsonl_documents(spark, jsonl(folder, line, '{"_id":"b","n":4}'))
    written = sl.write_documents(docs, folder + "/out", "long", mapping, 1)
    fields = sl.restore(spark, written.path).where("_id = 'a'").select("fields.*").first()
    assert fields["x"] == long and fields["k"] == "k" + long and fields["n"] == 3
    rows = spark.createDataFrame([("a", long, "k" + long, 3)], "_id string, x string, k string, n long")
    written = sl.write_snapshot(rows, folder + "/rows", "long", mapping, 1)
    assert sl.restore(spark, written.path).select("fields.*").first() == fields
    with pytest.raises(PySparkException, match="does not fit the mapping in n"):
        bad = sl.read_jsonl_documents(spark, jsonl(folder, json.dumps({"_id": "a", "x": long, "n": "q"})))
        sl.write_documents(bad, folder + "/bad", "long", mapping, 1)


def test_both_paths_store_the_same_texts(spark, folder):
    mapping = {"properties": dict.fromkeys(["f", "d", "t", "b", "l", "a"], {"type": "keyword"})}
    rows = spark.sql(
        "select 'a' as _id, 1.0d as f, 12345678901234567890.50 as d, timestamp'2024-01-02 03:04:05.123456' as t, "
        "true as b, 7L as l, array(1.0d, 2.5d) as a"
    )
    by_type = sl.open_snapshot(spark, sl.write_snapshot(rows, folder + "/rows", "i", mapping, 1).path)
    docs = sl.documents_from_dataframe(rows)
    by_json = sl.open_snapshot(spark, sl.write_documents(docs, folder + "/json", "i", mapping, 1).path)
    found = [s.documents().select("fields.*", "lists.a").collect() for s in (by_type, by_json)]
    assert found[0] == found[1]
    assert found[0][0][:6] == ("1.0", "12345678901234567890.50", "2024-01-02T03:04:05.123456Z", "true", "7", "1.0")


NUMBERS = st.one_of(
    st.integers(-(10**60), 10**60).map(str),
    st.decimals(allow_nan=False, allow_infinity=False).map(lambda d: f"{d:f}" if abs(d.as_tuple().exponent) < 60 else "1e-70"),
    st.tuples(st.integers(-9, 9), st.integers(-500, 500)).map(lambda p: f"{p[0]}e{p[1]}"),
)


@settings(max_examples=3, phases=[Phase.generate], deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(NUMBERS, NUMBERS), min_size=20, max_size=40, unique_by=lambda p: p[0]))
def test_numbers_stay_as_written(spark, pairs):
    lines = ['{"x":%s,"_id":%s,"y":[%s]}' % (b, a, b) for a, b in pairs]
    rows = sl.read_jsonl_documents(spark, jsonl(tempfile.mkdtemp(prefix="run-", dir="/tmp"), *lines)).collect()
    assert {(r["_id"], r["source"]) for r in rows} == {(a, '{"x":%s,"y":[%s]}' % (b, b)) for a, b in pairs}


def test_custom_id_stays_in_the_source(spark, folder):
    assert read(spark, folder, '{"docid":7,"text":"x"}', id_field="docid") == {
        "7": {"docid": 7, "text": "x"}
    }


def test_keep_id_overrides_both_defaults(spark, folder):
    line = '{"docid":7,"_id":"a"}'
    assert read(spark, folder, line, id_field="docid", keep_id=False) == {"7": {"_id": "a"}}
    assert read(spark, folder, line, keep_id=True) == {"a": {"docid": 7, "_id": "a"}}


def test_id_field_with_path_characters(spark, folder):
    line = '{"a.b$[0]":"k","x":1}'
    assert read(spark, folder, line, id_field="a.b$[0]", keep_id=False) == {"k": {"x": 1}}


@pytest.mark.parametrize("line", ['{"text":"x"}', '{"_id":null,"text":"x"}'])
def test_missing_id_fails(spark, folder, line):
    with pytest.raises(PySparkException, match="missing id field _id in .*in.jsonl"):
        read(spark, folder, '{"_id":"ok"}', line)


@pytest.mark.parametrize("line", ["{bad", "[1]", "5", "null", '{"_id":"a","x":1,"x":2}', '{"_id":"a"'])
def test_malformed_lines_fail(spark, folder, line):
    with pytest.raises(PySparkException, match="line in .*in.jsonl is not a JSON object"):
        read(spark, folder, '{"_id":"ok"}', line)


def test_rows_become_documents(spark):
    df = spark.createDataFrame(
        [Row(k=7, text="x", n=None, nested=Row(a=1, b=[1, 2]), tags={"t": 1})],
        "k int, text string, n int, nested struct<a: int, b: array<int>>, tags map<string, int>",
    )
    row = sl.documents_from_dataframe(df, "k").first()
    assert row["_id"] == "7"
    assert json.loads(row["source"]) == {
        "text": "x", "n": None, "nested": {"a": 1, "b": [1, 2]}, "tags": {"t": 1},
    }


def test_rows_can_keep_the_id(spark):
    df = spark.createDataFrame([(7, "x")], "k int, text string")
    assert json.loads(sl.documents_from_dataframe(df, "k", keep_id=True).first()["source"]) == {
        "k": 7, "text": "x",
    }


def test_row_with_nothing_but_an_id(spark):
    df = spark.createDataFrame([("a",)], "_id string")
    assert sl.documents_from_dataframe(df).collect() == [Row(_id="a", source="{}")]


def test_row_id_null_fails(spark):
    df = spark.createDataFrame([(None, "x")], "_id string, text string")
    with pytest.raises(PySparkException, match="missing id field _id"):
        sl.documents_from_dataframe(df).collect()


def test_row_id_column_missing(spark):
    with pytest.raises(ValueError, match="id field k is not a column"):
        sl.documents_from_dataframe(spark.range(1), "k")


def test_odd_column_names(spark):
    df = spark.createDataFrame([("a", 1, 2)], ["_id", "x.y", "back`tick"])
    assert json.loads(sl.documents_from_dataframe(df).first()["source"]) == {
        "x.y": 1, "back`tick": 2,
    }


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    df = spark.sql("select 'a' as _id, timestamp_micros(1700000000123456) as ts")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        source = json.loads(sl.documents_from_dataframe(df).first()["source"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert source == {"ts": "2023-11-14T22:13:20.123456Z"}


def test_only_the_used_columns_are_scanned(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    docs = sl.documents_from_dataframe(df.select("c_custkey", "c_name"), "c_custkey")
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in plan
    assert "Python" not in plan


def test_upsert_keeps_the_newest(spark):
    df = spark.createDataFrame(
        [("a", 1, "old"), ("a", 3, "new"), ("a", 2, "mid"), ("b", None, "n"), ("b", 0, "z")],
        "_id string, ts int, v string",
    )
    kept = {r["_id"]: r["v"] for r in sl.upsert_by_id(df, "ts").collect()}
    assert kept == {"a": "new", "b": "z"}


def test_upsert_breaks_ties_the_same_way_each_time(spark):
    rows = [("a", 1, f"v{i:03}") for i in range(200)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "_id string, ts int, v string").repartition(7)
        assert sl.upsert_by_id(df, F.col("ts")).collect() == [Row(_id="a", ts=1, v="v199")]


def test_upsert_with_maps(spark):
    df = spark.createDataFrame([("a", 1, {"x": 1}), ("a", 2, {"x": 2})], "_id string, ts int, m map<string,int>")
    assert sl.upsert_by_id(df, ["ts"]).first()["m"] == {"x": 2}


def test_upsert_breaks_ties_of_maps_and_variants(spark):
    rows = " union all ".join(f"select 'a' as _id, 1 as ts, map('k', {i}) as m, parse_json('{i}') as v" for i in (3, 5, 4))
    for n in (1, 4):
        row = sl.upsert_by_id(spark.sql(rows).repartition(n), "ts").selectExpr("m", "to_json(v) as v").first()
        assert (row["m"], row["v"]) == ({"k": 5}, "5")


def test_upsert_needs_an_order(spark):
    with pytest.raises(ValueError, match="order_by"):
        sl.upsert_by_id(spark.range(1), [], "id")


def test_upsert_cuts_rows_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("string(id % 3) as _id", "id as ts")
    plan = sl.upsert_by_id(df, "ts")._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange hashpartitioning", 1)[1]
    assert "WindowGroupLimit" in below and "Partial" in below


SCALARS = st.one_of(
    st.none(),
    st.booleans(),
    st.integers(-(10**30), 10**30),
    st.floats(allow_nan=False, allow_infinity=False),
    st.text(max_size=20),
)
VALUES = st.recursive(
    SCALARS,
    lambda inner: st.one_of(
        st.lists(inner, max_size=4), st.dictionaries(st.text(max_size=6), inner, max_size=4)
    ),
    max_leaves=8,
)


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    docs=st.dictionaries(
        st.text(max_size=12), st.dictionaries(st.text(max_size=6), VALUES, max_size=5),
        min_size=30, max_size=60,
    )
)
def test_any_json_survives(spark, docs):
    docs = {i: {k: v for k, v in d.items() if k != "_id"} for i, d in docs.items()}
    lines = [json.dumps({"_id": i, **d}) for i, d in docs.items()]
    assert read(spark, tempfile.mkdtemp(prefix="run-", dir="/tmp"), *lines) == docs
