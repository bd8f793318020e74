import json
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import shardloom as sl
from shardloom.config import snapshot_path
from shardloom.operators.conform import StrictMappingError, row_conformance

LONG = {"properties": {"n": {"type": "long"}}}


def docs(spark, *sources):
    rows = [(f"d{i}", s if isinstance(s, str) else json.dumps(s)) for i, s in enumerate(sources)]
    return spark.createDataFrame(rows, "_id string, source string")


def field(kind, **more):
    return {"properties": {"n": {"type": kind, **more}}}


# --- mappings and settings ----------------------------------------------------------------


def test_strict_is_forced_and_input_is_left_alone():
    given = {"properties": {"a": {"type": "text"}}, "dynamic": "true"}
    assert sl.normalize_mapping(given)["dynamic"] == "strict"
    assert given["dynamic"] == "true"


def test_wrapper_is_kept():
    wrapped = sl.normalize_mapping('{"_doc":{"properties":{"a":{"type":"long"}}}}')
    assert wrapped == {"_doc": {"properties": {"a": {"type": "long"}}, "dynamic": "strict"}}
    assert sl.mapping_to_schema(wrapped).simpleString() == "struct<a:bigint>"


def test_doc_next_to_other_keys_is_no_wrapper():
    mapping = sl.normalize_mapping({"_doc": {}, "properties": {"a": {"type": "long"}}})
    assert mapping["dynamic"] == "strict" and mapping["_doc"] == {}


@pytest.mark.parametrize("mapping", [None, "", "{bad", "[1]", {"_doc": 5}, {"properties": {"a": 1}}])
def test_bad_mappings(mapping):
    with pytest.raises(ValueError, match="mapping"):
        sl.mapping_to_schema(sl.normalize_mapping(mapping))


def test_all_types():
    kinds = ["text", "keyword", "long", "integer", "short", "byte", "double", "float", "boolean", "date"]
    properties = {k: {"type": k} for k in kinds}
    properties["o"] = {"properties": {"x": {"type": "long"}}}
    properties["p"] = {"type": "object", "properties": {"y": {"type": "object"}}}
    assert sl.mapping_to_schema({"properties": properties}).simpleString() == (
        "struct<text:string,keyword:string,long:bigint,integer:int,short:smallint,byte:tinyint,"
        "double:double,float:float,boolean:boolean,date:timestamp,o:struct<x:bigint>>"
    )


def test_unknown_type():
    with pytest.raises(ValueError, match="field 'a.b': type 'geo' is not supported"):
        sl.mapping_to_schema({"properties": {"a": {"properties": {"b": {"type": "geo"}}}}})


KEYS = {
    "mapreduce.output.fileoutputformat.outputdir": "/out",
    "shardloom.resource": "general",
    "shardloom.number_of_shards": "3",
    "shardloom.mapping": json.dumps(LONG),
}


@pytest.fixture
def conf(spark):
    touched = []

    def put(**values):
        for name, value in values.items():
            spark.conf.set(name, value)
            touched.append(name)

    yield put
    for name in touched:
        spark.conf.unset(name)


def test_settings_from_keys(spark, conf):
    conf(**KEYS)
    config = sl.resolve_config(spark)
    assert (config.output_dir, config.index_name, config.num_shards) == ("/out", "general", 3)
    assert config.mapping == {**LONG, "dynamic": "strict"} and config.id_field == "_id"


def test_write_key_wins_over_general_and_argument_over_both(spark, conf):
    conf(**KEYS, **{"shardloom.resource.write": "special", "shardloom.mapping.id": "k"})
    assert sl.resolve_config(spark).index_name == "special"
    assert sl.resolve_config(spark).id_field == "k"
    assert sl.resolve_config(spark, index_name="mine", id_field="z").index_name == "mine"


def test_hadoop_prefix_and_own_prefix(spark, conf):
    conf(**{f"spark.hadoop.{k}".replace("shardloom.", "mine."): v for k, v in KEYS.items()})
    assert sl.resolve_config(spark, prefix="mine").num_shards == 3


@pytest.mark.parametrize(
    ("missing", "message"),
    [
        ("mapreduce.output.fileoutputformat.outputdir", "folder .*outputdir in the session, .*spark.hadoop."),
        ("shardloom.resource", "name .*resource.write or shardloom.resource "),
        ("shardloom.number_of_shards", "shard count.*number_of_shards "),
        ("shardloom.mapping", "mapping .*shardloom.mapping "),
    ],
)
def test_missing_settings(spark, conf, missing, message):
    conf(**{k: v for k, v in KEYS.items() if k != missing})
    with pytest.raises(ValueError, match=message):
        sl.resolve_config(spark)


def test_keys_of_the_hadoop_configuration(spark, conf):
    conf(**{k: v for k, v in KEYS.items() if k != "shardloom.mapping"})
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("shardloom.mapping", KEYS["shardloom.mapping"])
    try:
        assert sl.resolve_config(spark).mapping == sl.normalize_mapping(KEYS["shardloom.mapping"])
    finally:
        hadoop.unset("shardloom.mapping")


@pytest.mark.parametrize("value", ["NaN", "Infinity", "-Infinity", "1e400"])
def test_reals_are_finite(spark, folder, value):
    mapping = {"properties": {"n": {"type": "double"}}}
    docs = spark.createDataFrame([("d0", json.dumps({"n": value}))], "_id string, source string")
    assert sl.nonconforming_fields(docs, mapping).count() == 1
    row = spark.createDataFrame([("d0", float(value))], "_id string, n double")
    with pytest.raises(PySparkException, match="document d0 does not fit the mapping in n"):
        sl.write_snapshot(row, folder, "reals", mapping, 1)


@pytest.mark.parametrize("shards", ["0", "-2", "many"])
def test_bad_shard_counts(spark, conf, shards):
    conf(**{**KEYS, "shardloom.number_of_shards": shards})
    with pytest.raises(ValueError, match=">= 1"):
        sl.resolve_config(spark)


def test_snapshot_path():
    assert snapshot_path("s3a://b/out/", "job_1", "test") == "s3a://b/out/job_1/test"


# --- JSON sources -------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("kind", "value", "typed"),
    [
        ("long", 5, 5), ("long", "5", 5), ("long", 5.7, 5), ("long", -5.7, -5), ("long", None, None),
        ("byte", 127, 127), ("short", "-3", -3), ("integer", 7, 7),
        ("double", "2.5", 2.5), ("double", 2, 2.0), ("float", 0.5, 0.5),
        ("boolean", True, True), ("boolean", "false", False),
        ("text", "x", "x"), ("text", 5, "5"), ("keyword", True, "true"),
    ],
)
def test_values_that_fit(spark, kind, value, typed):
    row = sl.conform_to_mapping(docs(spark, {"n": value}), field(kind)).first()
    assert row["fields"]["n"] == typed
    assert json.loads(row["source"]) == {"n": value}


def test_dates_that_fit(spark):
    sources = [{"n": "2024-01-02T03:04:05Z"}, {"n": "2024-01-02T04:04:05+01:00"}, {"n": 1704164645000}]
    conformed = sl.conform_to_mapping(docs(spark, *sources), field("date"))
    assert {str(r["n"]) for r in conformed.select(F.col("fields.n").cast("string").alias("n")).collect()} == {
        "2024-01-02 03:04:05"
    }


@pytest.mark.parametrize(
    ("kind", "value"),
    [
        ("long", "q"), ("long", "5.7"), ("long", True), ("long", [1, "q"]), ("long", {"a": 1}),
        ("byte", 128), ("long", 1e30), ("double", "q"), ("double", False), ("boolean", 1),
        ("boolean", "yes"), ("date", "q"), ("date", True), ("text", {"a": 1}), ("keyword", ["a", {"b": 1}]),
    ],
)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_values_that_do_not_fit(spark, kind, value, ansi):
    source = docs(spark, {"n": value})
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="document d0 does not fit the mapping in n"):
            sl.conform_to_mapping(source, field(kind)).collect()
        assert sl.nonconforming_fields(source, field(kind)).collect() == [("n", 1)]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


NESTED = {
    "properties": {
        "a": {"type": "long"},
        "o": {"properties": {"x": {"type": "long"}, "p": {"properties": {"y": {"type": "text"}}}}},
    }
}


def test_nested_values(spark):
    sources = [{"o": {"x": 1, "p": {"y": "t"}}}, {"a": 1, "o": None}, {"a": 2, "o": {"p": None}}, {}]
    rows = sl.conform_to_mapping(docs(spark, *sources), NESTED).orderBy("_id").collect()
    assert [r["fields"].asDict(recursive=True) for r in rows] == [
        {"a": None, "o": {"x": 1, "p": {"y": "t"}}},
        {"a": 1, "o": None},
        {"a": 2, "o": {"x": None, "p": None}},
        {"a": None, "o": None},
    ]


@pytest.mark.parametrize("source", [{"o": 5}, {"o": [{"x": 1}, 5]}, {"o": {"p": "s"}}, {"o": {"x": "q"}}])
def test_nested_values_that_do_not_fit(spark, source):
    with pytest.raises(PySparkException, match="does not fit the mapping in o"):
        sl.conform_to_mapping(docs(spark, source), NESTED).collect()


@pytest.mark.parametrize(
    ("source", "path"),
    [
        ({"a": 1, "z": 1}, "z"), ({"z": None}, "z"), ({"o": {"x": 1, "q": 2}}, "o.q"),
        ({"o": {"p": {"y": "t", "w": {}}}}, "o.p.w"),
    ],
)
def test_undeclared_fields_fail(spark, source, path):
    given = docs(spark, {"a": 1}, source)
    message = f"document d1 has undeclared fields {path}"
    with pytest.raises(PySparkException, match=message):
        sl.conform_to_mapping(given, NESTED).collect()
    with pytest.raises(PySparkException, match=message):
        sl.reject_undeclared_fields(given, NESTED).collect()
    assert sl.undeclared_fields(given, NESTED).collect() == [(path, 1)]


def test_declared_fields_pass_unchanged(spark):
    given = docs(spark, {"a": 1, "o": {"p": {"y": "t"}}}, {})
    assert sl.reject_undeclared_fields(given, NESTED).collect() == given.collect()


def test_field_names_with_path_characters(spark):
    mapping = {"properties": {"a.b": {"type": "long"}, "it's $[0]": {"type": "long"}}}
    row = sl.conform_to_mapping(docs(spark, {"a.b": 1, "it's $[0]": 2}), mapping).first()
    assert row["fields"]["a"]["b"] == 1 and row["fields"]["it's $[0]"] == 2


# --- rows ---------------------------------------------------------------------------------


def conform(df, mapping):
    made = row_conformance(None, df.schema, mapping)
    return df.select(F.lit("d0").alias("_id"), "*").select(
        (made.typed if made.guard is None else F.when(made.guard, made.typed)).alias("fields"), *made.columns()[1:]
    )


@pytest.mark.parametrize(
    ("kind", "sql", "typed"),
    [
        ("long", "5", 5), ("long", "'5'", 5), ("long", "5.7d", 5), ("long", "null", None),
        ("long", "5.7", 5), ("byte", "bigint(7)", 7), ("double", "float(0.5)", 0.5),
        ("text", "5", "5"), ("keyword", "true", "true"), ("boolean", "'true'", True),
        ("double", "decimal(2.5)", 3.0), ("text", "date'2024-01-02'", "2024-01-02"),
    ],
)
def test_columns_that_fit(spark, kind, sql, typed):
    assert conform(spark.sql(f"select {sql} as n"), field(kind)).first()["fields"]["n"] == typed


@pytest.mark.parametrize(
    ("kind", "sql"), [("long", "'q'"), ("long", "'5.7'"), ("byte", "300"), ("date", "'q'"), ("boolean", "'yes'")]
)
def test_column_values_that_do_not_fit(spark, kind, sql):
    with pytest.raises(PySparkException, match="document d0 does not fit the mapping in n"):
        conform(spark.sql(f"select {sql} as n"), field(kind)).collect()


@pytest.mark.parametrize(
    ("kind", "sql"),
    [("long", "true"), ("long", "struct(1)"), ("text", "struct(1)"), ("boolean", "1"), ("date", "true")],
)
def test_column_types_that_do_not_fit(spark, kind, sql):
    with pytest.raises(StrictMappingError, match="field n"):
        conform(spark.sql(f"select {sql} as n"), field(kind))


def test_undeclared_columns_fail_without_a_job(spark):
    df = spark.sql("select raise_error('job ran') as a, struct(1 as x, 2 as q) as o, 3 as z")
    with pytest.raises(StrictMappingError, match="undeclared fields o.q, z"):
        row_conformance(None, df.schema, NESTED)


def test_filters_on_typed_fields_do_not_parse_again(spark):
    conformed = sl.conform_to_mapping(docs(spark, {"a": 1}, {"a": 9}), NESTED)
    kept = conformed.where("fields.a > 5 and fields.o.x is null")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"parse_?[jJ]son\(source#", plan)) == 1
    assert [r["_id"] for r in kept.collect()] == ["d1"]


# --- lists, dotted names, parameters ----------------------------------------------------------


LISTS = {"properties": {"t": {"type": "keyword"}, "n": {"type": "long"}, "x": {"type": "text"}, "o": {"properties": {"k": {"type": "long"}, "p": {"properties": {"d": {"type": "date"}}}}}}}


def both(spark, mapping, *sources):
    rows = sl.conform_to_mapping(docs(spark, *sources), mapping).orderBy("_id").collect()
    return [(r["fields"].asDict(recursive=True), r["lists"].asDict(recursive=True)) for r in rows]


@pytest.mark.parametrize(
    ("source", "one", "several"),
    [
        ({"t": ["x", "y"], "n": 1}, {"t": "x", "n": 1}, {"t": ["x", "y"]}),
        ({"t": ["x"]}, {"t": "x"}, {}), ({"t": []}, {}, {}), ({"t": [None, "y"]}, {"t": "y"}, {}),
        ({"n": [[1, [2, "3"]], 4.5]}, {"n": 1}, {"n": [1, 2, 3, 4]}),
        ({"t": ["[", "a.b"], "x": "a [list] of none"}, {"t": "[", "x": "a [list] of none"}, {"t": ["[", "a.b"]}),
        ({"t": [True, 5, "5"]}, {"t": "true"}, {"t": ["true", "5", "5"]}),
        ({"o": [{"k": 1}, {"k": [2, 3]}, None, {}]}, {"o": {"k": 1, "p": None}}, {"o": {"k": [1, 2, 3], "p": None}}),
        ({"o": {"k": [1, 2]}}, {"o": {"k": 1, "p": None}}, {"o": {"k": [1, 2], "p": None}}),
    ],
)
def test_lists(spark, source, one, several):
    found_one, found_several = both(spark, LISTS, source)[0]
    assert found_one == {**dict.fromkeys("tnxo"), **one}
    assert {k: v for k, v in found_several.items() if v != {"k": None, "p": {"d": None}} and v is not None} == {
        **several
    }


@pytest.mark.parametrize(
    ("dotted", "nested"),
    [
        ({"o.k": 1}, {"o": {"k": 1}}), ({"o.p.d": "2024-01-02"}, {"o": {"p": {"d": "2024-01-02"}}}),
        ({"o.p": {"d": "2024-01-02"}, "o": {"k": 3}}, {"o": {"p": {"d": "2024-01-02"}, "k": 3}}),
        ({"o": {"p.d": "2024"}}, {"o": {"p": {"d": "2024"}}}), ({"o.k": 1, "o": {"k": 2}}, {"o": [{"k": 1}, {"k": 2}]}),
        ({"o.k": None, "n": 1}, {"o": {"k": None}, "n": 1}),
    ],
)
def test_dotted_keys_are_paths(spark, dotted, nested):
    (one, several), (expected, expected_several) = both(spark, LISTS, dotted, nested)
    assert one == expected
    for s in (several, expected_several):
        if s["o"] is not None and s["o"]["k"] is not None:
            s["o"]["k"].sort()
    assert (several["o"] or {}).get("k") == (expected_several["o"] or {}).get("k")


@pytest.mark.parametrize(
    ("source", "path"), [({"o.z": 1}, "o.z"), ({"o": [{"k": 1}, {"q": 1}]}, "o.q"), ({"o": {"p.z": 1}}, "o.p.z"), ({"n.k": 1}, "n.k")]
)
def test_undeclared_in_lists_and_paths(spark, source, path):
    given = docs(spark, source)
    assert sl.undeclared_fields(given, LISTS).collect() == [(path, 1)]
    with pytest.raises(PySparkException, match=f"undeclared fields {path}"):
        sl.conform_to_mapping(given, LISTS).collect()


@pytest.mark.parametrize("source", [{"n": [1, "q"]}, {"o": [{"k": 1}, 5]}, {"o.k": "q"}, {"o": {"k": [[["q"]]]}}, {"n": [[[[[1]]]]]}])
def test_lists_that_do_not_fit(spark, source):
    with pytest.raises(PySparkException, match="document d0 does not fit the mapping in [no]"):
        sl.conform_to_mapping(docs(spark, source), LISTS).collect()


def test_declared_names_with_dots():
    mapping = {"properties": {"a.b": {"type": "long"}, "a": {"properties": {"c": {"type": "text"}}}, "a.d.e": {"type": "date"}}}
    schema = sl.mapping_to_schema(mapping)
    assert schema.simpleString() == "struct<a:struct<b:bigint,c:string,d:struct<e:timestamp>>>"
    for twice in ({"a.b": {"type": "long"}, "a": {"properties": {"b": {"type": "long"}}}}, {"a": {"type": "long"}, "a.b": {"type": "long"}}):
        with pytest.raises(ValueError, match="declared twice"):
            sl.mapping_to_schema({"properties": twice})
    with pytest.raises(ValueError, match="empty part"):
        sl.mapping_to_schema({"properties": {"a.": {"type": "long"}}})


@pytest.mark.parametrize(
    ("sql", "one", "several"),
    [
        ("array('x','y') as t", "x", ["x", "y"]), ("array(null,'y') as t", "y", None), ("array('x') as t", "x", None),
        ("array(array('x'),array('y',null),null) as t", "x", ["x", "y"]), ("array(1.5d, 2d) as t", "1.5", ["1.5", "2.0"]),
        ("cast(null as array<string>) as t", None, None), ("array() as t", None, None),
    ],
)
def test_array_columns(spark, sql, one, several):
    row = conform(spark.sql(f"select {sql}"), LISTS).first()
    assert row["fields"]["t"] == one and row["lists"]["t"] == several


def test_array_columns_without_json(spark):
    df = spark.sql("select array(named_struct('k', 1), named_struct('k', 2), null) as o, array(1L, 2L) as n, 5 as `o.p.d`")
    with pytest.raises(StrictMappingError, match="o is given by several columns"):
        conform(df, LISTS)
    row = conform(df.drop("o.p.d"), LISTS).first()
    assert row["lists"]["o"]["k"] == [1, 2] and row["fields"]["o"]["k"] == 1 and row["lists"]["n"] == [1, 2]
    with pytest.raises(PySparkException, match="does not fit the mapping in n"):
        conform(spark.sql("select array('1', 'q') as n"), LISTS).collect()
    with pytest.raises(StrictMappingError, match="field n"):
        conform(spark.sql("select array(true) as n"), LISTS)


def test_dotted_columns(spark):
    df = spark.sql("select 7L as `o.k`, named_struct('d', date'2024-01-02') as `o.p`, 'a' as t")
    row = conform(df, LISTS).first()["fields"]
    assert row["o"]["k"] == 7 and str(row["o"]["p"]["d"]) == "2024-01-02 00:00:00"
    assert conform(spark.sql("select 7L as `o.k`, named_struct('p', named_struct('d', null)) as o"), LISTS).first()["fields"]["o"]["k"] == 7
    with pytest.raises(StrictMappingError, match="o.k is given by several columns"):
        conform(spark.sql("select 7L as `o.k`, named_struct('k', 1L) as o"), LISTS)
    with pytest.raises(StrictMappingError, match="undeclared fields o.z"):
        conform(spark.sql("select 7L as `o.z`"), LISTS)


def texts_of(spark, sources, mapping, column):
    rows = sl.conform_to_mapping(docs(spark, *sources), mapping).orderBy("_id")
    return [r[0] for r in rows.select(F.col(f"fields.{column}").cast("string")).collect()]


@pytest.mark.parametrize(
    ("format", "value", "typed"),
    [
        ("yyyy/MM/dd", "2024/01/02", "2024-01-02 00:00:00"), ("basic_date", "20240102", "2024-01-02 00:00:00"),
        ("basic_date", 20240102, "2024-01-02 00:00:00"), ("epoch_second", 1704164645, "2024-01-02 03:04:05"),
        ("strict_date_hour_minute_second||epoch_millis", "2024-01-02T03:04:05", "2024-01-02 03:04:05"),
        ("dd.MM.yyyy||strict_date_optional_time", "2024-01-02T03:04:05Z", "2024-01-02 03:04:05"),
        ("dd.MM.yyyy||yyyy", "2024", "2024-01-01 00:00:00"), ("yyyy/MM/dd", "2024-01-02", None), ("epoch_second", "q", None),
    ],
)
def test_date_formats(spark, format, value, typed):
    mapping = {"properties": {"n": {"type": "date", "format": format}}}
    if typed is None:
        assert sl.nonconforming_fields(docs(spark, {"n": value}), mapping).collect() == [("n", 1)]
    else:
        assert texts_of(spark, [{"n": value}, {"n": [value, value]}], mapping, "n") == [typed, typed]
        row = conform(spark.createDataFrame([(value,)], ["n"]), mapping).first()
        assert str(row["fields"]["n"]) == typed


def test_malformed_values_are_left_out(spark):
    mapping = {"properties": {"n": {"type": "long", "ignore_malformed": True}, "d": {"type": "date", "ignore_malformed": "true"}, "s": {"type": "long"}}}
    sources = [{"n": "q", "d": "x", "s": 1}, {"n": [1, "q", 3]}, {"n": 5, "d": "2024-01-02"}]
    rows = sl.conform_to_mapping(docs(spark, *sources), mapping).orderBy("_id").collect()
    assert [r["ignored"] for r in rows] == [["n", "d"], ["n"], []]
    assert [r["fields"]["n"] for r in rows] == [None, 1, 5] and rows[1]["lists"]["n"] == [1, 3]
    row = conform(spark.sql("select 'q' as n, 'x' as d, 1 as s"), mapping).first()
    assert row["ignored"] == ["n", "d"] and row["fields"]["s"] == 1
    with pytest.raises(PySparkException, match="does not fit the mapping in s"):
        sl.conform_to_mapping(docs(spark, {"s": "q"}), mapping).collect()


@pytest.mark.parametrize(("kind", "value"), [("long", "5"), ("long", 5.5), ("double", "2.5"), ("byte", [1.0, 2.5])])
def test_without_coercion(spark, kind, value):
    mapping = {"properties": {"n": {"type": kind, "coerce": False}}}
    assert sl.nonconforming_fields(docs(spark, {"n": value}, {"n": 3}, {"n": 4.0}), mapping).collect() == [("n", 1)]
    with pytest.raises(PySparkException, match="does not fit the mapping in n"):
        conform(spark.createDataFrame([(value,)], ["n"]), mapping).collect()


def test_null_values(spark):
    mapping = {"properties": {"n": {"type": "long", "null_value": -1}, "t": {"type": "keyword", "null_value": "none"}, "d": {"type": "date", "null_value": "2000-01-01"}, "b": {"type": "boolean", "null_value": True}}}
    found = both(spark, mapping, {"n": None, "t": None, "d": None, "b": None}, {"n": [1, None]}, {})
    assert found[0][0]["n"] == -1 and found[0][0]["t"] == "none" and found[0][0]["b"] is True and str(found[0][0]["d"]) == "2000-01-01 00:00:00"
    assert found[1][1]["n"] == [1, -1] and found[2][0]["n"] is None
    assert conform(spark.sql("select cast(null as long) as n"), mapping).first()["fields"]["n"] == -1


def test_objects_that_are_not_parsed(spark):
    mapping = {"properties": {"o": {"type": "object", "enabled": False}, "n": {"type": "long"}}}
    found = both(spark, mapping, {"o": {"any": [{"thing": 1}]}, "n": 1}, {"o": 5}, {"o": [1, "x"]}, {"o.q": 1})
    assert [one for one, _ in found[:3]] == [{"n": 1}, {"n": None}, {"n": None}]
    assert conform(spark.sql("select named_struct('a', 1) as o, 2 as n"), mapping).first()["fields"]["n"] == 2


@pytest.mark.parametrize(
    ("spec", "message"),
    [
        ({"type": "long", "formt": "x"}, "unknown parameter 'formt'"), ({"type": "long", "format": "yyyy"}, "takes no parameter 'format'"),
        ({"type": "keyword", "coerce": True}, "takes no parameter 'coerce'"), ({"type": "text", "enabled": False}, "takes no parameter 'enabled'"),
        ({"type": "long", "ignore_malformed": "maybe"}, "must be true or false"), ({"type": "date", "format": "yyyy||"}, "empty alternative"),
    ],
)
def test_unknown_parameters(spec, message):
    with pytest.raises(ValueError, match=message):
        sl.mapping_to_schema({"properties": {"n": spec}})
    assert sl.mapping_to_schema({"properties": {"n": {"type": "keyword", "ignore_above": 256, "doc_values": False}}})
