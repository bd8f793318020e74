
from __future__ import annotations

import sys
import warnings
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import shardloom as sl
from shardloom.plans.scratch import scratch_dir

try:
    import corpus_pipeline
    import shardloom.llm.registry as llm
except ImportError as missing:
    # Both can be left out together, and so can the libraries that only they need.
    if getattr(missing, "name", None) not in ("corpus_pipeline", "shardloom.llm", "shardloom.llm.registry"):
        warnings.warn(f"queries of the optional subpackage are left out: {missing}", stacklevel=1)
    llm = corpus_pipeline = None

SMALL = "/root/testdata/sf0.001"

QUERY_TEXT = "the onesen verblest leaux"

DOCUMENTS = {
    "properties": {
        "doc_id": {"type": "long"},
        "text": {"type": "text"},
        "lang": {"type": "keyword"},
        "source": {"type": "keyword"},
        "n_chars": {"type": "integer"},
    }
}
ORDERS = {
    "_doc": {
        "properties": {
            "o_orderkey": {"type": "long"},
            "o_custkey": {"type": "long"},
            "o_orderstatus": {"type": "keyword"},
            "o_totalprice": {"type": "double"},
            "o_orderdate": {"type": "date"},
            "o_orderpriority": {"type": "keyword"},
        }
    }
}
EVENTS = {
    "properties": {
        "event_id": {"type": "long"},
        "user_id": {"type": "long"},
        "event_type": {"type": "keyword"},
        "value": {"type": "double"},
        "props": {"properties": {"k": {"type": "integer"}}},
    }
}
NATION = {
    "properties": {
        "n_nationkey": {"type": "integer"},
        "n_name": {"type": "text"},
        "n_regionkey": {"type": "integer"},
    }
}
PART = '{"properties":{"p_partkey":{"type":"long"},"p_name":{"type":"text"}}}'
PAGES = {
    "properties": {
        "page_id": {"type": "long"},
        "url": {"type": "keyword"},
        "html": {"type": "text"},
    }
}
LINEITEM = {
    "properties": {
        "l_orderkey": {"type": "long"},
        "l_partkey": {"type": "long"},
        "l_suppkey": {"type": "long"},
        "l_linenumber": {"type": "integer"},
        "l_quantity": {"type": "double"},
        "l_extendedprice": {"type": "double"},
        "l_discount": {"type": "double"},
        "l_tax": {"type": "double"},
        "l_returnflag": {"type": "keyword"},
        "l_linestatus": {"type": "keyword"},
        "l_shipdate": {"type": "date"},
    }
}


EMBEDDINGS = {
    "properties": {
        "vec_id": {"type": "long"},
        "embedding": {"type": "float"},
        "label": {"type": "integer"},
    }
}
TAGGED = {
    "properties": {
        "user_id": {"type": "long"},
        "tags": {"type": "keyword"},
        "values": {"type": "double"},
    }
}
TURNS = {
    "properties": {
        "turns.turn": {"type": "long"},
        "turns.role": {"type": "keyword"},
        "turns.text": {"type": "text"},
    }
}
FORMATS = {
    "properties": {
        "day": {"type": "date", "format": "dd.MM.yyyy||yyyy/MM/dd"},
        "seconds": {"type": "date", "format": "epoch_second"},
        "month": {"type": "date", "format": "strict_year_month"},
    }
}
MALFORMED = {
    "properties": {
        "event_type": {"type": "keyword"},
        "value": {"type": "integer", "ignore_malformed": True, "null_value": -1},
        "at": {"type": "date", "ignore_malformed": True},
    }
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key(name: str) -> Column:
    """``id<number>``: ASCII ids, for which the SQL counterpart can hash."""
    return F.concat(F.lit("id"), F.col(name).cast("string")).alias("_id")


def keyed(df: DataFrame, name: str) -> DataFrame:
    return df.select(key(name), "*")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(table(spark, sf_dir, "documents"), "doc_id")


def indexed(
    df: DataFrame, index: str, mapping: dict | str, num_shards: int, **options
) -> sl.Snapshot:
    """Write a snapshot to a scratch folder and open it."""
    spark = df.sparkSession
    written = sl.write_snapshot(df, scratch_dir(spark), index, mapping, num_shards, **options)
    return sl.open_snapshot(spark, written.path)


# --- routing ------------------------------------------------------------------------------


def shard_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = documents(spark, sf_dir).select("_id")
    return sl.with_shard(sl.with_routing_hash(ids), 2)


def shard_routing_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sl.with_shard(table(spark, sf_dir, "orders").select(key("o_orderkey")), 5)


def shard_routing_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return sl.with_shard(turns.select(F.concat_ws("-", "conv_id", "turn").alias("_id")), 3)


def shard_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "region").select(key("r_regionkey"))
    return sl.shard_counts(sl.with_shard(ids, 16), 16)


def partition_by_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = sl.with_shard(documents(spark, sf_dir), 6)
    return sl.partition_counts(sl.partition_by_shard(routed, 6))


def verify_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = indexed(keyed(table(spark, sf_dir, "orders"), "o_orderkey"), "orders", ORDERS, 4)
    return snapshot.verify_routing().agg(F.count(F.lit(1)).alias("misrouted"))


# --- documents ----------------------------------------------------------------------------


def documents_from_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = sl.documents_from_dataframe(table(spark, sf_dir, "customer"), "c_custkey")
    fields = F.from_json("source", "c_name string, c_nationkey int, c_acctbal double")
    return docs.select(
        "_id",
        fields["c_name"].alias("c_name"),
        fields["c_nationkey"].alias("c_nationkey"),
        fields["c_acctbal"].alias("c_acctbal"),
        F.get_json_object("source", "$.c_custkey").isNotNull().alias("id_in_source"),
    )


def documents_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        key("vec_id"), "embedding", F.struct("label", "vec_id").alias("meta")
    )
    fields = F.from_json("source", "embedding array<float>, meta struct<label int, vec_id bigint>")
    return sl.documents_from_dataframe(rows).select(
        "_id",
        F.size(fields["embedding"]).alias("n_values"),
        fields["embedding"][0].cast("double").alias("first_value"),
        fields["meta"]["label"].alias("label"),
        fields["meta"]["vec_id"].alias("vec_id"),
    )


def _events_jsonl(spark: SparkSession, sf_dir: str, id_field: str) -> str:
    """Events as JSON lines, padded, and with a blank line after each that has an even id."""
    path = f"{scratch_dir(spark)}/events"
    props = F.from_json("props", "k int").alias("props")
    members = [key("event_id")] if id_field == "_id" else []
    line = F.to_json(F.struct(*members, "event_id", "user_id", "event_type", "value", props))
    padded = F.concat(F.lit(" \t"), line, F.lit("\t "))
    blank = F.when(F.col("event_id") % 2 == 0, F.lit(" \t ")).otherwise(F.lit(None))
    lines = table(spark, sf_dir, "events").select(
        F.explode(F.array_compact(F.array(padded, blank))).alias("value")
    )
    lines.write.text(path)
    return path


def _event_columns(docs: DataFrame) -> DataFrame:
    fields = F.from_json(
        "source", "user_id bigint, event_type string, value double, props struct<k int>"
    )
    return docs.select(
        "_id",
        fields["user_id"].alias("user_id"),
        fields["event_type"].alias("event_type"),
        fields["value"].alias("value"),
        fields["props"]["k"].alias("k"),
        F.get_json_object("source", "$._id").isNotNull().alias("has_id"),
        F.get_json_object("source", "$.event_id").isNotNull().alias("has_event_id"),
    )


def jsonl_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_columns(sl.read_jsonl_documents(spark, _events_jsonl(spark, sf_dir, "_id")))


def jsonl_custom_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _events_jsonl(spark, sf_dir, "event_id")
    return _event_columns(sl.read_jsonl_documents(spark, path, id_field="event_id"))


def null_fields_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    rows = documents(spark, sf_dir).join(labels, "doc_id", "left")
    fields = F.from_json("source", "map<string,string>").alias("fields")
    docs = sl.documents_from_dataframe(rows).select(fields)
    has_key = F.map_contains_key("fields", "quality")
    return docs.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if(has_key).alias("n_with_key"),
        F.count_if(has_key & F.col("fields")["quality"].isNull()).alias("n_null"),
    )


# --- strict mappings ----------------------------------------------------------------------


def _event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        key("event_id"),
        "event_id",
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        "value",
        F.from_json("props", "k int").alias("props"),
    )
    return sl.documents_from_dataframe(events)


def conform_to_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sl.conform_to_mapping(_event_documents(spark, sf_dir), EVENTS).select(
        "_id", "fields.user_id", "fields.event_type", "fields.value", "fields.props.k"
    )


def undeclared_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow = {"properties": {"event_type": {"type": "keyword"}, "props": {"properties": {}}}}
    return sl.undeclared_fields(_event_documents(spark, sf_dir), narrow)


def nonconforming_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrong = {
        "properties": {
            "event_id": {"type": "byte"},
            "user_id": {"type": "long"},
            "event_type": {"type": "long"},
            "value": {"type": "boolean"},
            "props": {"type": "keyword"},
        }
    }
    return sl.nonconforming_fields(_event_documents(spark, sf_dir), wrong)


def conform_dates_with_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates in three formats of their own; every other day is written in the second of two."""
    first, second = F.date_format("ts", "dd.MM.yyyy"), F.date_format("ts", "yyyy/MM/dd")
    day = F.when(F.col("event_id") % 2 == 0, first).otherwise(second)
    events = table(spark, sf_dir, "events").select(
        key("event_id"),
        day.alias("day"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("seconds"),
        F.date_format("ts", "yyyy-MM").alias("month"),
    )
    fields = sl.conform_to_mapping(sl.documents_from_dataframe(events), FORMATS).select("_id", "fields.*")
    return fields.select("_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("day", "seconds", "month")])


def ignore_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that fit no number or date are left out and named; nulls have a value of their own."""
    n = F.col("event_id") % 4
    value = F.when(n == 0, F.col("event_type")).when(n == 1, F.lit(None)).otherwise(F.col("event_id").cast("string"))
    at = F.when(n == 2, F.lit("never")).otherwise(F.lit("2024-01-02"))
    events = table(spark, sf_dir, "events").select(key("event_id"), "event_type", value.alias("value"), at.alias("at"))
    made = sl.conform_to_mapping(sl.documents_from_dataframe(events), MALFORMED)
    return made.select(
        "_id", "fields.value", F.col("fields.at").cast("date").alias("at"), F.array_join("ignored", ",").alias("ignored")
    )


def conform_dotted_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose ``props.k`` is written as a path in every other document."""
    nested = F.to_json(F.struct("event_type", F.from_json("props", "k int").alias("props")))
    dotted = F.to_json(F.struct("event_type", F.from_json("props", "k int")["k"].alias("props.k")))
    source = F.when(F.col("event_id") % 2 == 0, nested).otherwise(dotted)
    docs = table(spark, sf_dir, "events").select(key("event_id"), source.alias("source"))
    mapping = {"properties": {"event_type": {"type": "keyword"}, "props.k": {"type": "integer"}}}
    return sl.conform_to_mapping(docs, mapping).select("_id", "fields.event_type", "fields.props.k")


def jsonl_number_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of up to 40 digits as ids and values: both stay as they are written."""
    number = F.concat(F.lit("1"), "event_id", F.lit("00000000000000000000000000000000.10"))
    line = F.concat(F.lit('{"n":'), number, F.lit(',"_id":'), number, F.lit(',"e":[{"_id":1e400}]}'))
    path = f"{scratch_dir(spark)}/numbers"
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    return sl.read_jsonl_documents(spark, path)


# --- snapshots ----------------------------------------------------------------------------


def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = indexed(documents(spark, sf_dir), "documents", DOCUMENTS, 5)
    return snapshot.documents().select("_id", "fields.*")


def snapshot_roundtrip_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = indexed(keyed(table(spark, sf_dir, "pages"), "page_id"), "pages", PAGES, 3)
    return snapshot.documents().select("_id", "fields.*")


def snapshot_from_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = sl.read_jsonl_documents(spark, _events_jsonl(spark, sf_dir, "_id"))
    written = sl.write_documents(docs, scratch_dir(spark), "events", EVENTS, 4)
    restored = sl.restore(spark, written.path)
    return restored.select(
        "_id", "shard", "fields.user_id", "fields.event_type", "fields.value", "fields.props.k"
    )


def snapshot_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of arrays: fields with a list of values."""
    rows = keyed(table(spark, sf_dir, "embeddings"), "vec_id")
    snapshot = indexed(rows, "embeddings", EMBEDDINGS, 3)
    values = snapshot.values("embedding")
    micro = F.aggregate(values, F.lit(0).cast("bigint"), lambda total, x: total + F.floor(x.cast("double") * 1_000_000))
    return snapshot.documents().select(
        "_id", "fields.vec_id", "fields.label", F.size(values).alias("n_values"),
        F.col("fields.embedding").cast("double").alias("first_value"),
        F.element_at(values, -1).cast("double").alias("last_value"), micro.alias("sum_micro"),
    )


def snapshot_tags_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines with none, one or several tags and with lists in lists."""
    k = F.from_json("props", "k int")["k"]
    tags = (
        F.when(k % 4 == 0, F.lit("[]"))
        .when(k % 4 == 1, F.to_json(F.array("event_type")))
        .when(k % 4 == 2, F.concat(F.lit('"'), "event_type", F.lit('"')))
        .otherwise(F.concat(F.lit('["'), "event_type", F.lit('",null,["k'), k.cast("string"), F.lit('",["z"]]]')))
    )
    parts = [F.lit('{"_id":"id'), F.col("event_id"), F.lit('","user_id":'), F.col("user_id"), F.lit(',"tags":'), tags]
    line = F.concat(*parts, F.lit(',"values":['), F.col("event_id"), F.lit(',"0.5"]}'))
    path = f"{scratch_dir(spark)}/tags"
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    written = sl.write_documents(sl.read_jsonl_documents(spark, path), scratch_dir(spark), "tags", TAGGED, 4)
    snapshot = sl.open_snapshot(spark, written.path)
    return snapshot.documents().select(
        "_id", "fields.user_id", F.col("fields.tags").alias("first_tag"), F.array_join(snapshot.values("tags"), ",").alias("tags"),
        F.aggregate(snapshot.values("values"), F.lit(0.0), lambda a, b: a + b).alias("total"),
    )


def snapshot_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of objects per document: the turns of a conversation."""
    turn = F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    rows = table(spark, sf_dir, "conversations").groupBy(key("conv_id")).agg(turn)
    snapshot = indexed(rows, "turns", TURNS, 3)
    return snapshot.documents().select(
        "_id", F.size(snapshot.values("turns.turn")).alias("n_turns"), F.array_join(snapshot.values("turns.role"), ",").alias("roles"),
        F.col("fields.turns.text").alias("first_text"), F.element_at(snapshot.values("turns.text"), -1).alias("last_text"),
    )


def snapshot_to_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows turned into documents by a hook of the caller."""

    def to_document(df: DataFrame) -> DataFrame:
        title = F.upper("s_name").alias("title")
        return sl.documents_from_dataframe(df.select(key("s_suppkey"), title))

    mapping = {"properties": {"title": {"type": "keyword"}}}
    suppliers = table(spark, sf_dir, "supplier")
    snapshot = indexed(suppliers, "suppliers", mapping, 2, to_document=to_document)
    return snapshot.documents().select("_id", "shard", "fields.title")


def snapshot_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order and line number are not unique in this table: the line shipped last is kept."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("_id"), "*"
    )
    newest = ["l_shipdate", "l_partkey", "l_suppkey"]
    restored = indexed(lines, "lineitem", LINEITEM, 7, order_by=newest).documents()
    return restored.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(F.col("fields.l_quantity").cast("decimal(18,2)")).cast("double").alias("sum_qty"),
        F.max("fields.l_shipdate").cast("date").alias("last_shipdate"),
    )


def snapshot_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = keyed(table(spark, sf_dir, "nation"), "n_nationkey")
    return indexed(nations, "nation", NATION, 8).manifest().drop("index_uuid", "mapping")


def upsert_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("user"), "user_id").alias("_id"), "event_id", "ts", "event_type", "value"
    )
    return sl.upsert_by_id(events, ["ts", "event_id"])


def snapshot_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = {
        "properties": {
            "event_id": {"type": "long"},
            "ts": {"type": "date"},
            "value": {"type": "float"},
        }
    }
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("user"), "user_id").alias("_id"), "event_id", "ts", "value"
    )
    snapshot = indexed(events, "users", mapping, 3, order_by=["ts", "event_id"])
    return snapshot.documents().select(
        "_id", "shard", "fields.event_id", F.col("fields.ts").cast("timestamp_ntz").alias("ts")
    )


# --- restored snapshots -------------------------------------------------------------------


def match_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = indexed(documents(spark, sf_dir), "documents", DOCUMENTS, 5).match_all(10)
    doc_id = F.get_json_object("_source", "$.doc_id").cast("bigint").alias("doc_id")
    return hits.select("_index", "_id", "_score", doc_id)


def total_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indexed(documents(spark, sf_dir), "documents", DOCUMENTS, 5).total_hits()


def shards_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indexed(documents(spark, sf_dir), "documents", DOCUMENTS, 5).shards_summary()


def get_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = keyed(table(spark, sf_dir, "part"), "p_partkey").select("_id", "p_partkey", "p_name")
    return indexed(parts, "part", PART, 2).get_mapping()


def index_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = keyed(table(spark, sf_dir, "nation"), "n_nationkey")
    return indexed(nations, "nation", NATION, 8).index_metadata()


# --- search tables ------------------------------------------------------------------------


def field_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sl.analyze(keyed(table(spark, sf_dir, "benchmark"), "item_id"), "text", "_id")


def _postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sl.postings(sl.with_shard(documents(spark, sf_dir).select("_id", "text"), 3))


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _postings(spark, sf_dir).withColumn("positions", F.array_join("positions", ","))


def term_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sl.term_dictionary(_postings(spark, sf_dir))


def field_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sl.field_stats(_postings(spark, sf_dir))


def match_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals, counts and hits are read from postings that are made and stored once."""
    path = f"{scratch_dir(spark)}/postings"
    _postings(spark, sf_dir).write.parquet(path)
    post = spark.read.parquet(path)
    terms = QUERY_TEXT.split()
    return sl.match_query(post, sl.field_stats(post), terms, 20).select("_id", "_score")


def match_all_large_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page that ends within a shard, with its documents."""
    snapshot = indexed(documents(spark, sf_dir), "documents", DOCUMENTS, 5)
    hits = snapshot.match_all(777)
    fields = F.from_json("_source", "doc_id bigint, lang string, n_chars int")
    return hits.select("_index", "_id", "_score", *[fields[c].alias(c) for c in ("doc_id", "lang", "n_chars")])


def stored_term_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = indexed(documents(spark, sf_dir), "documents", DOCUMENTS, 4)
    snapshot.write_search_tables("text")
    return snapshot.term_dictionary("text")


def misrouted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders placed by the remainder of their key instead of the hash of their id."""
    orders = table(spark, sf_dir, "orders")
    placed = orders.select(key("o_orderkey"), (F.col("o_orderkey") % 4).cast("int").alias("shard"))
    return sl.verify_routing(placed, 4)


def shard_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards whose stored rows are those that were written."""
    return indexed(documents(spark, sf_dir), "documents", DOCUMENTS, 5).shards_summary(contents=True)


def match_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search on the stored tables of a snapshot."""
    snapshot = indexed(documents(spark, sf_dir), "documents", DOCUMENTS, 4)
    snapshot.write_search_tables("text")
    return snapshot.match("text", QUERY_TEXT, 20).select("_index", "_id", "_score")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: snapshot the documents, restore them, count per shard."""
    snapshot = indexed(documents(spark, SMALL), "documents", DOCUMENTS, 4)
    return sl.shard_counts(snapshot.documents(), snapshot.num_shards)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries: those of the library, then those of its optional subpackage."""
    optional = {} if llm is None else llm.queries() | {"pipeline": corpus_pipeline.run}
    return core_queries() | optional


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        query.__name__: query
        for query in (
            shard_routing,
            shard_routing_many,
            shard_routing_composite,
            shard_counts,
            partition_by_shard,
            verify_routing,
            documents_from_rows,
            documents_nested,
            jsonl_documents,
            jsonl_custom_id,
            null_fields_kept,
            conform_to_mapping,
            undeclared_fields,
            nonconforming_fields,
            conform_dates_with_format,
            ignore_malformed,
            conform_dotted_names,
            jsonl_number_ids,
            snapshot_roundtrip,
            snapshot_roundtrip_pages,
            snapshot_from_jsonl,
            snapshot_embeddings,
            snapshot_tags_jsonl,
            snapshot_turns,
            snapshot_to_document,
            snapshot_lineitem,
            snapshot_manifest,
            upsert_by_id,
            snapshot_upsert,
            match_all,
            total_hits,
            shards_summary,
            get_mapping,
            index_metadata,
            field_tokens,
            postings,
            term_dictionary,
            field_stats,
            match_query,
            match_stored,
            match_all_large_page,
            stored_term_dictionary,
            misrouted_documents,
            shard_contents,
        )
    }


# --- SQL counterparts ---------------------------------------------------------------------


def _hashed(ids: str) -> str:
    """CTEs that end in ``hashed(_id, hash)``: MurmurHash3 of ASCII ids, two characters a step.

    ``ids`` is a query for the column ``_id``.
    """
    word, mod = "4294967295", "4294967296"
    c1, c2 = "3432918353::HUGEINT", "461845907::HUGEINT"
    unit = "unicode(substr(_id, {at}, 1))::BIGINT"
    first, second = unit.format(at="2 * i + 1"), unit.format(at="2 * i + 2")
    last = unit.format(at="length(_id)")
    return f"""
    RECURSIVE ids AS (SELECT DISTINCT _id FROM ({ids})),
    blocks(_id, i, h) AS (
        SELECT _id, 0, 0::BIGINT FROM ids
        UNION ALL
        SELECT _id, i + 1, ((r * 5 + 3864292196) % {mod})::BIGINT FROM (
            SELECT _id, i, ((x << 13) | (x >> 19)) & {word} AS r FROM (
                SELECT _id, i, xor(h, ((q * {c2}) % {mod})::BIGINT) AS x FROM (
                    SELECT _id, i, h, ((p << 15) | (p >> 17)) & {word} AS q FROM (
                        SELECT _id, i, h,
                               ((({first} + 65536 * {second}) * {c1}) % {mod})::BIGINT AS p
                        FROM blocks WHERE i < length(_id) // 2))))
    ),
    whole AS (SELECT _id, max_by(h, i) AS h FROM blocks GROUP BY _id),
    tail AS (
        SELECT _id, h, CASE WHEN length(_id) % 2 = 1
                            THEN (({last} * {c1}) % {mod})::BIGINT ELSE 0 END AS p FROM whole
    ),
    mixed AS (
        SELECT _id, xor(xor(h, (((((p << 15) | (p >> 17)) & {word}) * {c2}) % {mod})::BIGINT),
                        2 * length(_id)) AS a FROM tail
    ),
    f1 AS (SELECT _id, ((xor(a, a >> 16) * 2246822507::HUGEINT) % {mod})::BIGINT AS a FROM mixed),
    f2 AS (SELECT _id, ((xor(a, a >> 13) * 3266489909::HUGEINT) % {mod})::BIGINT AS a FROM f1),
    f3 AS (SELECT _id, xor(a, a >> 16) AS a FROM f2),
    hashed AS (SELECT _id, (CASE WHEN a > 2147483647 THEN a - {mod} ELSE a END)::INTEGER AS hash
               FROM f3)"""


#: Virtual shards for the numbers of shards that the queries use.
ROUTING_SHARDS = {2: 1024, 3: 768, 4: 1024, 5: 640, 6: 768, 7: 896, 8: 1024, 16: 1024}


def _shard(num_shards: int, hash_value: str = "hash") -> str:
    routing = ROUTING_SHARDS[num_shards]
    return (
        f"((({hash_value} % {routing}) + {routing}) % {routing} // {routing // num_shards})::INTEGER"
    )


def _id(column: str) -> str:
    return f"('id' || {column})"


def _routed(ids: str, num_shards: int) -> str:
    """``_hashed`` plus ``routed(_id, shard)``."""
    return f"""{_hashed(ids)},
    routed AS (SELECT _id, {_shard(num_shards)} AS shard FROM hashed)"""


def _ids(name: str, column: str) -> str:
    return f"SELECT {_id(column)} AS _id FROM {name}"


TOKENS = r"""
    tokens AS (
        SELECT _id, term, position - 1 AS position FROM (
            SELECT _id, unnest(list) AS term, generate_subscripts(list, 1) AS position FROM (
                SELECT _id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'),
                                        lambda x: x <> '') AS list FROM texts))
    )"""

DOCUMENT_TERMS = f"""
    texts AS (SELECT {_id("doc_id")} AS _id, text FROM documents), {TOKENS},
    terms AS (
        SELECT _id, term, count(*) AS tf,
               string_agg(position::VARCHAR, ',' ORDER BY position) AS positions
        FROM tokens GROUP BY _id, term
    ),
    lengths AS (SELECT _id, count(*) AS doc_len FROM tokens GROUP BY _id)"""


def _bm25(columns: str) -> str:
    terms = ", ".join(f"'{term}'" for term in QUERY_TEXT.split())
    return f"""
    WITH {DOCUMENT_TERMS},
    totals AS (SELECT count(*) AS n, sum(doc_len) / count(*) AS avg_len FROM lengths),
    hits AS (SELECT * FROM terms WHERE term IN ({terms})),
    df AS (SELECT term, count(*) AS df FROM hits GROUP BY term),
    shares AS (
        SELECT _id, CAST(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf / (
            tf + 1.2::DOUBLE * (1 - 0.75::DOUBLE + 0.75::DOUBLE * doc_len / avg_len)
        ) AS DECIMAL(18, 6)) AS share
        FROM hits JOIN df USING (term) JOIN lengths USING (_id), totals
    ),
    best AS (SELECT _id, CAST(sum(share) AS DOUBLE) AS _score FROM shares GROUP BY _id)
    SELECT {columns} FROM best ORDER BY _score DESC, _id LIMIT 20"""




def oracle_sql() -> dict[str, str]:
    optional = {} if llm is None else llm.oracle_sql()
    if corpus_pipeline is not None and corpus_pipeline.ORACLE_SQL:
        optional["pipeline"] = corpus_pipeline.ORACLE_SQL
    return core_oracle_sql() | optional


def core_oracle_sql() -> dict[str, str]:
    docs = _ids("documents", "doc_id")
    event_columns = f"""
        {_id("event_id")} AS _id, user_id, event_type, value,
        CAST(json_extract(props, '$.k') AS INTEGER) AS k"""
    strict_part = (
        '{"properties":{"p_partkey":{"type":"long"},"p_name":{"type":"text"}},"dynamic":"strict"}'
    )
    return {
        "shard_routing": f"""
            WITH {_hashed(docs)} SELECT _id, hash, {_shard(2)} AS shard FROM hashed""",
        "shard_routing_many": f"""
            WITH {_routed(_ids("orders", "o_orderkey"), 5)} SELECT _id, shard FROM routed""",
        "shard_routing_composite": f"""
            WITH {_routed("SELECT conv_id || '-' || turn AS _id FROM conversations", 3)}
            SELECT _id, shard FROM routed""",
        "shard_counts": f"""
            WITH {_routed(_ids("region", "r_regionkey"), 16)}
            SELECT n::INTEGER AS shard, count(_id) AS doc_count
            FROM range(16) AS shards(n) LEFT JOIN routed ON shard = n GROUP BY n""",
        "partition_by_shard": f"""
            WITH {_routed(docs, 6)}
            SELECT shard, shard AS partition, count(*) AS n_rows FROM routed GROUP BY shard""",
        "verify_routing": "SELECT count(*) AS misrouted FROM orders WHERE o_orderkey IS NULL",
        "documents_from_rows": """
            SELECT c_custkey::VARCHAR AS _id, c_name, c_nationkey, c_acctbal,
                   false AS id_in_source FROM customer""",
        "documents_nested": f"""
            SELECT {_id("vec_id")} AS _id, len(embedding)::INTEGER AS n_values,
                   embedding[1]::DOUBLE AS first_value, label, vec_id FROM embeddings""",
        "jsonl_documents": f"""
            SELECT {event_columns}, false AS has_id, true AS has_event_id FROM events""",
        "jsonl_custom_id": f"""
            SELECT event_id::VARCHAR AS _id, user_id, event_type, value,
                   CAST(json_extract(props, '$.k') AS INTEGER) AS k,
                   false AS has_id, true AS has_event_id FROM events""",
        "null_fields_kept": """
            SELECT count(*) AS n_docs, count(*) AS n_with_key,
                   count(*) FILTER (WHERE quality IS NULL) AS n_null
            FROM documents LEFT JOIN labels USING (doc_id)""",
        "conform_to_mapping": f"SELECT {event_columns} FROM events",
        "undeclared_fields": """
            SELECT field, count(*) AS n_docs FROM (
                SELECT unnest(['event_id', 'user_id', 'value'] ||
                              list_transform(json_keys(props), lambda k: 'props.' || k)) AS field
                FROM events) GROUP BY field""",
        "nonconforming_fields": """
            SELECT field, count(*) AS n_docs FROM (
                SELECT unnest(list_filter([
                    CASE WHEN event_id > 127 THEN 'event_id' END,
                    CASE WHEN TRY_CAST(event_type AS BIGINT) IS NULL THEN 'event_type' END,
                    'value', 'props'], lambda f: f IS NOT NULL)) AS field
                FROM events) GROUP BY field""",
        "conform_dates_with_format": f"""
            SELECT {_id("event_id")} AS _id, date_trunc('day', ts)::TIMESTAMP AS day,
                   date_trunc('second', ts) AS seconds, date_trunc('month', ts)::TIMESTAMP AS month FROM events""",
        "ignore_malformed": f"""
            SELECT {_id("event_id")} AS _id,
                   CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN -1 ELSE event_id END::INTEGER AS value,
                   CASE WHEN event_id % 4 = 2 THEN NULL ELSE DATE '2024-01-02' END AS at,
                   CASE event_id % 4 WHEN 0 THEN 'value' WHEN 2 THEN 'at' ELSE '' END AS ignored FROM events""",
        "conform_dotted_names": f"""
            SELECT {_id("event_id")} AS _id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",
        "jsonl_number_ids": """
            SELECT '1' || event_id || '00000000000000000000000000000000.10' AS _id,
                   '{"n":1' || event_id || '00000000000000000000000000000000.10,"e":[{"_id":1e400}]}' AS source FROM events""",
        "snapshot_embeddings": f"""
            SELECT {_id("vec_id")} AS _id, vec_id, label, len(embedding)::INTEGER AS n_values,
                   embedding[1]::DOUBLE AS first_value, embedding[-1]::DOUBLE AS last_value,
                   list_sum(list_transform(embedding, lambda x: floor(x::DOUBLE * 1000000)::BIGINT))::BIGINT AS sum_micro
            FROM embeddings""",
        "snapshot_tags_jsonl": f"""
            WITH tagged AS (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)
            SELECT {_id("event_id")} AS _id, user_id, CASE WHEN k % 4 = 0 THEN NULL ELSE event_type END AS first_tag,
                   CASE k % 4 WHEN 0 THEN '' WHEN 3 THEN event_type || ',k' || k || ',z' ELSE event_type END AS tags,
                   event_id + 0.5::DOUBLE AS total FROM tagged""",
        "snapshot_turns": f"""
            SELECT {_id("conv_id")} AS _id, count(turn)::INTEGER AS n_turns, string_agg(role, ',' ORDER BY turn) AS roles,
                   arg_min(text, turn) AS first_text, arg_max(text, turn) AS last_text
            FROM conversations GROUP BY conv_id""",
        "snapshot_roundtrip": f"""
            SELECT {_id("doc_id")} AS _id, doc_id, text, lang, source, n_chars::INTEGER AS n_chars
            FROM documents""",
        "snapshot_roundtrip_pages": f"""
            SELECT {_id("page_id")} AS _id, page_id, url, html FROM pages""",
        "snapshot_from_jsonl": f"""
            WITH {_routed(_ids("events", "event_id"), 4)},
            rows AS (SELECT {event_columns} FROM events)
            SELECT _id, shard, user_id, event_type, value, k FROM rows JOIN routed USING (_id)""",
        "snapshot_to_document": f"""
            WITH {_routed(_ids("supplier", "s_suppkey"), 2)}
            SELECT _id, shard, upper(s_name) AS title
            FROM supplier JOIN routed ON _id = {_id("s_suppkey")}""",
        "snapshot_lineitem": f"""
            WITH {_routed("SELECT l_orderkey || '-' || l_linenumber AS _id FROM lineitem", 7)},
            newest AS (
                SELECT * FROM lineitem QUALIFY row_number() OVER (
                    PARTITION BY l_orderkey, l_linenumber
                    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1
            )
            SELECT shard, count(*) AS n_docs,
                   sum(l_quantity::DECIMAL(18, 2))::DOUBLE AS sum_qty,
                   max(l_shipdate)::DATE AS last_shipdate
            FROM newest JOIN routed ON _id = l_orderkey || '-' || l_linenumber GROUP BY shard""",
        "snapshot_manifest": f"""
            WITH {_routed(_ids("nation", "n_nationkey"), 8)}
            SELECT 'nation' AS index_name, 'snap' AS snapshot, 0 AS generation, 8 AS num_shards,
                   1024 AS num_routing_shards, 0 AS num_replicas, '_id' AS id_field,
                   n::INTEGER AS shard, count(_id) AS doc_count
            FROM range(8) AS shards(n) LEFT JOIN routed ON shard = n GROUP BY n""",
        "upsert_by_id": """
            SELECT 'user' || user_id AS _id, event_id, ts, event_type, value FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
        "snapshot_upsert": f"""
            WITH {_routed("SELECT 'user' || user_id AS _id FROM events", 3)}
            SELECT _id, shard, event_id, ts FROM events JOIN routed ON _id = 'user' || user_id
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
        "match_all": f"""
            WITH {_routed(docs, 5)}
            SELECT 'documents' AS _index, _id, 1.0::DOUBLE AS _score, doc_id
            FROM documents JOIN routed ON _id = {_id("doc_id")} ORDER BY shard, _id LIMIT 10""",
        "total_hits": "SELECT count(*) AS value, 'eq' AS relation FROM documents",
        "shards_summary": """
            SELECT 5::BIGINT AS total, 5::BIGINT AS successful, 0::BIGINT AS skipped,
                   0::BIGINT AS failed""",
        "get_mapping": f"SELECT 'part' AS index_name, '{strict_part}' AS mapping",
        "index_metadata": """
            SELECT 'nation' AS index_name, 'snap' AS snapshot, 0 AS generation, 8 AS num_shards,
                   1024 AS num_routing_shards, 0 AS num_replicas, count(*) AS doc_count
            FROM nation""",
        "field_tokens": f"""
            WITH texts AS (SELECT {_id("item_id")} AS _id, text FROM benchmark), {TOKENS}
            SELECT _id, position::INTEGER AS position, term FROM tokens""",
        "postings": f"""
            WITH {_routed(docs, 3)}, {DOCUMENT_TERMS}
            SELECT shard, term, _id, tf::INTEGER AS tf, positions, doc_len::INTEGER AS doc_len
            FROM terms JOIN lengths USING (_id) JOIN routed USING (_id)""",
        "term_dictionary": f"""
            WITH {DOCUMENT_TERMS}
            SELECT term, count(*) AS doc_freq, sum(tf)::BIGINT AS total_tf
            FROM terms GROUP BY term""",
        "field_stats": f"""
            WITH {DOCUMENT_TERMS}
            SELECT count(*) AS doc_count, sum(doc_len)::BIGINT AS sum_tokens,
                   sum(doc_len) / count(*) AS avg_len FROM lengths""",
        "match_query": _bm25("_id, _score"),
        "match_all_large_page": f"""
            WITH {_routed(docs, 5)}
            SELECT 'documents' AS _index, _id, 1.0::DOUBLE AS _score, doc_id, lang, n_chars::INTEGER AS n_chars
            FROM documents JOIN routed ON _id = {_id("doc_id")} ORDER BY shard, _id LIMIT 777""",
        "stored_term_dictionary": f"""
            WITH {DOCUMENT_TERMS}
            SELECT term, count(*) AS doc_freq, sum(tf)::BIGINT AS total_tf
            FROM terms GROUP BY term""",
        "misrouted_documents": f"""
            WITH {_hashed(_ids("orders", "o_orderkey"))},
            placed AS (SELECT {_id("o_orderkey")} AS _id, (o_orderkey % 4)::INTEGER AS shard FROM orders)
            SELECT _id, placed.shard, {_shard(4)} AS expected_shard FROM placed JOIN hashed USING (_id)
            WHERE placed.shard <> {_shard(4)}""",
        "shard_contents": """
            SELECT 5::BIGINT AS total, 5::BIGINT AS successful, 0::BIGINT AS skipped,
                   0::BIGINT AS failed""",
        "match_stored": _bm25("'documents' AS _index, _id, _score"),
    }
