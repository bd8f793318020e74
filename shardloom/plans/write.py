"""Write a snapshot: documents, routed to shards, with a manifest committed last.

Layout of a snapshot directory::

    docs/shard=<k>/part=<p>/*.parquet
                               _id, source (JSON), fields (typed columns but for text), lists (all values
                               of fields with several), ignored (fields that left values out), digest;
                               sorted by id; the part is a hash of the id
    zones/*.json               one row per file: rows, digest, and ids at some ranks
    manifest/*.json            one row per shard; its presence makes the directory a snapshot
    search/<field>/...         optional, see ``shardloom.plans.search_tables``
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardloom.config import SnapshotConfig, check_output, new_job_id, snapshot_path
from shardloom.functions.hashing import num_routing_shards
from shardloom.mapping import (
    ignores_malformed,
    lists_type,
    mapping_json,
    mapping_to_schema,
    stored_fields,
    text_fields,
)
from shardloom.operators.conform import (
    Conformed,
    check_columns,
    fits_by_schema,
    json_conformance,
    row_conformance,
)
from shardloom.operators.documents import extract_id, require_id, to_source_json
from shardloom.operators.routing import (
    parts_per_shard,
    spread,
    with_empty_shards,
    with_shard,
)
from shardloom.operators.upsert import upsert_by_id
from shardloom.sources.jsonl import read_jsonl_documents
from shardloom.sources.rows import documents_from_dataframe, source_struct

# Fixed values of a snapshot directory: one snapshot, first generation, no replicas.
SNAPSHOT_NAME = "snap"
GENERATION = 0
REPLICAS = 0

NOT_UNIQUE = "ids are not unique,"
ZONES_SCHEMA = (
    "shard int, part int, file string, num_parts int, doc_count bigint, digest decimal(38,0), "
    "ranks array<struct<rank:bigint,_id:string>>"
)

OrderBy = Column | str | Sequence[Column | str] | None


class DuplicateIdError(ValueError):
    """Several rows share an id and nothing tells which one is the newest."""


@dataclass(frozen=True)
class WrittenSnapshot:
    path: str
    job_id: str
    index_name: str
    num_shards: int


def docs_path(path: str) -> str:
    return f"{path}/docs"


def zones_path(path: str) -> str:
    return f"{path}/zones"


def manifest_path(path: str) -> str:
    return f"{path}/manifest"


def docs_schema(mapping: Mapping[str, Any] | str) -> T.StructType:
    schema = T.StructType().add("_id", T.StringType()).add("source", T.StringType())
    fields = stored_fields(mapping)
    if fields.fields:
        schema = schema.add("fields", fields)
    declared = mapping_to_schema(mapping)
    if declared.fields:
        schema = schema.add("lists", lists_type(declared))
    if ignores_malformed(mapping):
        schema = schema.add("ignored", T.ArrayType(T.StringType()))
    return schema.add("digest", T.LongType()).add("shard", T.IntegerType()).add("part", T.IntegerType())


def part_of(doc_id: Column, num_parts: int | Column) -> Column:
    """Which part of its shard a document is in."""
    parts = F.lit(num_parts) if isinstance(num_parts, int) else num_parts
    return F.pmod(F.xxhash64(doc_id), parts).cast("int")


def digest_of(doc_id: Column, source: Column) -> Column:
    return F.xxhash64(doc_id, source)


def write_snapshot(
    df: DataFrame,
    output_path: str,
    index_name: str,
    mapping: Mapping[str, Any] | str,
    num_shards: int,
    id_field: str = "_id",
    *,
    job_id: str | None = None,
    order_by: OrderBy = None,
    to_document: Callable[[DataFrame], DataFrame] | None = None,
) -> WrittenSnapshot:
    """Snapshot the rows of ``df`` under ``<output_path>/<job_id>/<index_name>``.

    All columns but the id are fields and must be declared.  Rows with the same id are an error
    unless ``order_by`` tells which one is the newest.  ``to_document`` maps the input to
    ``(_id, source)`` documents of its own making, which are then checked as JSON.
    """
    config = SnapshotConfig(output_path, index_name, mapping, num_shards, id_field)
    if to_document is not None:
        return _write_json(df.transform(to_document), config, job_id, order_by)
    if id_field not in df.columns:
        raise ValueError(f"id field {id_field} is not a column of the input")

    newest = df if order_by is None else upsert_by_id(df, order_by, id_field)
    unique = order_by is not None
    schema = T.StructType([f for f in df.schema.fields if f.name != id_field])
    check_columns(schema, config.mapping)
    if not fits_by_schema(schema) or not schema.fields:
        # Maps and variants say too little by type: check their values as JSON.
        docs = documents_from_dataframe(newest, id_field)
        return _write_json(docs, config, job_id, None, unique)

    row = F.col("__row")
    made = row_conformance(row, schema, config.mapping, skip=text_fields(config.mapping))
    path, job_id = _target(df.sparkSession, config, job_id)
    keyed = newest.select(
        require_id(extract_id(id_field), id_field).alias("_id"),
        source_struct(schema.names).alias("__row"),
    )
    # JSON and typed copies are made after the shuffle: only one form of a row travels.
    return _commit(
        _to_shards(keyed, config.num_shards, unique), to_source_json(row), made,
        config, path, job_id,
    )


def write_documents(
    docs: DataFrame,
    output_path: str,
    index_name: str,
    mapping: Mapping[str, Any] | str,
    num_shards: int,
    *,
    job_id: str | None = None,
    order_by: OrderBy = None,
) -> WrittenSnapshot:
    """Snapshot ``(_id, source)`` documents whose source is JSON text already."""
    config = SnapshotConfig(output_path, index_name, mapping, num_shards)
    return _write_json(docs, config, job_id, order_by)


def write_jsonl_snapshot(
    spark: SparkSession,
    path: str | list[str],
    config: SnapshotConfig,
    *,
    job_id: str | None = None,
    order_by: OrderBy = None,
) -> WrittenSnapshot:
    """Snapshot files of JSON lines, with settings from ``resolve_config``."""
    docs = read_jsonl_documents(spark, path, config.id_field)
    return _write_json(docs, config, job_id, order_by)


def write_configured(
    df: DataFrame, config: SnapshotConfig, *, job_id: str | None = None, order_by: OrderBy = None
) -> WrittenSnapshot:
    """``write_snapshot`` with settings from ``resolve_config``."""
    return write_snapshot(
        df,
        config.output_dir,
        config.index_name,
        config.mapping,
        config.num_shards,
        config.id_field,
        job_id=job_id,
        order_by=order_by,
    )


def _write_json(
    docs: DataFrame,
    config: SnapshotConfig,
    job_id: str | None,
    order_by: OrderBy,
    unique: bool = False,
) -> WrittenSnapshot:
    path, job_id = _target(docs.sparkSession, config, job_id)
    newest = docs if order_by is None else upsert_by_id(docs, order_by)
    keyed = newest.select(require_id(extract_id("_id"), "_id").alias("_id"), "source")
    # Only the source travels; it is parsed and checked after the shuffle.
    made = json_conformance(
        _to_shards(keyed, config.num_shards, unique or order_by is not None),
        config.mapping, skip=text_fields(config.mapping),
    )
    return _commit(made.rows, F.col("source"), made, config, path, job_id)


def _target(spark: SparkSession, config: SnapshotConfig, job_id: str | None) -> tuple[str, str]:
    job_id = job_id or new_job_id()
    path = snapshot_path(config.output_dir, job_id, config.index_name)
    check_output(spark, path, config)
    return path, job_id


def _to_shards(docs: DataFrame, num_shards: int, unique: bool) -> DataFrame:
    """Rows shuffled by shard and part, sorted by id inside each task: the only shuffle of a write.

    A shard is cut into parts by a hash of the id.  The order gives Parquet narrow id ranges.  All rows of
    an id meet in one task, so unless ids are ``unique`` already, the order shows those that are not, and
    the job fails before it commits a file.
    """
    parts = parts_per_shard(docs.sparkSession, num_shards)
    routed = with_shard(docs, num_shards).withColumn("part", part_of(F.col("_id"), parts))
    if unique:
        return spread(routed, num_shards, F.col("part")).sortWithinPartitions("shard", "part", "_id")
    turns = spread(routed, num_shards, F.col("part"), split=False)
    same = Window.partitionBy("__turn", "shard", "part", "_id").orderBy(F.lit(0))
    again = F.row_number().over(same) > 1
    message = F.concat(F.lit(NOT_UNIQUE), F.lit(" for example "), F.col("_id"), F.lit(": pass order_by to keep the newest row of each"))
    one = F.when(again, F.raise_error(message).cast("string")).otherwise(F.col("_id"))
    return turns.withColumn("_id", one).drop("__turn")


def _commit(
    docs: DataFrame,
    source: Column,
    made: Conformed,
    config: SnapshotConfig,
    path: str,
    job_id: str,
) -> WrittenSnapshot:
    """Write documents, then the ranges of ids that the files hold, then the manifest.

    The guard is part of the stored source, so no document is written without its check.
    """
    checked = source if made.guard is None else F.when(made.guard, source)
    rows = docs.select("_id", checked.alias("source"), *made.columns(), "shard", "part")
    try:
        rows.withColumn("digest", digest_of(F.col("_id"), F.col("source"))).write.mode("errorifexists").option(
            "parquet.bloom.filter.enabled#_id", "true"
        ).partitionBy("shard", "part").parquet(docs_path(path))
    except PySparkException as error:
        if NOT_UNIQUE in str(error):
            found = re.search(f"{NOT_UNIQUE}.*", str(error))
            raise DuplicateIdError(found.group() if found else NOT_UNIQUE) from error
        raise
    spark = docs.sparkSession
    stored = spark.read.schema(docs_schema(config.mapping)).parquet(docs_path(path))
    parts = parts_per_shard(spark, config.num_shards)
    zones_of(stored, parts).coalesce(1).write.mode("errorifexists").json(zones_path(path))
    zones = spark.read.schema(ZONES_SCHEMA).json(zones_path(path))
    manifest = manifest_of(zones, config)
    manifest.coalesce(1).write.mode("errorifexists").json(manifest_path(path))
    return WrittenSnapshot(path, job_id, config.index_name, config.num_shards)


def zones_of(stored: DataFrame, num_parts: int) -> DataFrame:
    """One row per file: its rows, the sum of their digests, and its ids at ranks 0, 1, 3, 7, 15, ...

    Files are sorted by id, so the number of a row in its file is its rank.  Only ids and digests are read,
    and each task sends a few dozen ids per file.
    """
    row, file = F.col("_metadata.row_index"), F.col("_metadata.file_path")
    ranked = row.bitwiseAND(row + 1) == 0
    rows = stored.select("shard", "part", file.alias("file"), F.when(ranked, F.struct(row.alias("rank"), "_id")).alias("at"), "digest")
    return rows.groupBy("shard", "part", "file").agg(
        F.lit(num_parts).alias("num_parts"),
        F.count(F.lit(1)).alias("doc_count"),
        F.sum(F.col("digest").cast("decimal(38,0)")).alias("digest"),
        F.sort_array(F.collect_list("at")).alias("ranks"),
    )


def index_settings(num_shards: int) -> dict[str, int]:
    """What a snapshot records about its shards."""
    return {
        "num_shards": num_shards,
        "num_routing_shards": num_routing_shards(num_shards),
        "num_replicas": REPLICAS,
    }


def manifest_of(zones: DataFrame, config: SnapshotConfig) -> DataFrame:
    """One row per shard, empty shards included: index settings and document count."""
    constants = {
        "index_name": F.lit(config.index_name),
        "index_uuid": F.lit(uuid.uuid4().hex),
        "snapshot": F.lit(SNAPSHOT_NAME),
        "generation": F.lit(GENERATION),
        **{name: F.lit(value) for name, value in index_settings(config.num_shards).items()},
        "id_field": F.lit(config.id_field),
        "mapping": F.lit(mapping_json(config.mapping)),
    }
    counts = zones.groupBy("shard").agg(F.sum("doc_count").alias("doc_count"))
    return with_empty_shards(counts, config.num_shards).select(
        *[value.alias(name) for name, value in constants.items()], "shard", "doc_count"
    )
