"""Sharded document snapshots built as plain Spark jobs.

>>> from shardloom import write_snapshot, open_snapshot
>>> written = write_snapshot(df, "s3a://bucket/snapshots", "articles", mapping, 64)
>>> open_snapshot(spark, written.path).total_hits().show()
"""

from shardloom.config import SnapshotConfig, check_output, resolve_config, snapshot_path
from shardloom.functions.hashing import num_routing_shards, with_routing_hash
from shardloom.functions.tokens import analyze, token_array
from shardloom.mapping import mapping_from_dict, mapping_to_schema, normalize_mapping
from shardloom.operators.conform import (
    conform_to_mapping,
    nonconforming_fields,
    reject_undeclared_fields,
    undeclared_fields,
)
from shardloom.operators.documents import extract_id, require_id, to_source_json
from shardloom.operators.postings import field_stats, postings, term_dictionary
from shardloom.operators.routing import (
    check_partition_count,
    partition_by_shard,
    partition_counts,
    shard_counts,
    snapshot_skeleton,
    verify_routing,
    with_empty_shards,
    with_shard,
)
from shardloom.operators.search import match_query
from shardloom.operators.upsert import upsert_by_id
from shardloom.plans.restore import Snapshot, open_snapshot, read_manifest, restore
from shardloom.plans.search_tables import write_postings
from shardloom.plans.write import (
    WrittenSnapshot,
    index_settings,
    write_configured,
    write_documents,
    write_jsonl_snapshot,
    write_snapshot,
)
from shardloom.sources.jsonl import read_jsonl_documents
from shardloom.sources.rows import documents_from_dataframe

__all__ = [
    "Snapshot",
    "SnapshotConfig",
    "WrittenSnapshot",
    "analyze",
    "check_output",
    "check_partition_count",
    "conform_to_mapping",
    "documents_from_dataframe",
    "extract_id",
    "field_stats",
    "mapping_from_dict",
    "mapping_to_schema",
    "index_settings",
    "match_query",
    "nonconforming_fields",
    "normalize_mapping",
    "num_routing_shards",
    "open_snapshot",
    "partition_by_shard",
    "partition_counts",
    "postings",
    "read_jsonl_documents",
    "read_manifest",
    "reject_undeclared_fields",
    "require_id",
    "resolve_config",
    "restore",
    "shard_counts",
    "snapshot_path",
    "snapshot_skeleton",
    "term_dictionary",
    "to_source_json",
    "token_array",
    "undeclared_fields",
    "upsert_by_id",
    "verify_routing",
    "with_empty_shards",
    "with_routing_hash",
    "with_shard",
    "write_configured",
    "write_documents",
    "write_jsonl_snapshot",
    "write_postings",
    "write_snapshot",
]
