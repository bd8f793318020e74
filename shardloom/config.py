"""Job settings: explicit arguments first, then session configuration keys."""

from __future__ import annotations

import datetime
import secrets
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import SparkSession

from shardloom.mapping import mapping_to_schema, normalize_mapping

# Configuration keys; the first part of all but OUTPUT_DIR is a parameter.
PREFIX = "shardloom"
RESOURCE_WRITE = "resource.write"
RESOURCE = "resource"
NUMBER_OF_SHARDS = "number_of_shards"
MAPPING = "mapping"
ID_FIELD = "mapping.id"
OUTPUT_DIR = "mapreduce.output.fileoutputformat.outputdir"
HADOOP_PREFIX = "spark.hadoop."

DEFAULT_ID_FIELD = "_id"


@dataclass(frozen=True)
class SnapshotConfig:
    output_dir: str
    index_name: str
    mapping: dict[str, Any]
    num_shards: int
    id_field: str = DEFAULT_ID_FIELD

    def __post_init__(self) -> None:
        if not self.output_dir:
            raise ValueError("output directory missing: name the folder under which jobs put their snapshots")
        if not self.index_name or "/" in self.index_name:
            raise ValueError(f"index name must be non-empty and without '/': {self.index_name!r}")
        if isinstance(self.num_shards, bool) or not isinstance(self.num_shards, int):
            raise ValueError(f"number of shards must be an integer, not {self.num_shards!r}")
        if self.num_shards < 1:
            raise ValueError(f"number of shards must be >= 1, got {self.num_shards}")
        object.__setattr__(self, "mapping", normalize_mapping(self.mapping))
        mapping_to_schema(self.mapping)


def resolve_config(
    spark: SparkSession,
    *,
    output_dir: str | None = None,
    index_name: str | None = None,
    mapping: Mapping[str, Any] | str | None = None,
    num_shards: int | None = None,
    id_field: str | None = None,
    prefix: str = PREFIX,
) -> SnapshotConfig:
    """Fill what the caller left out from ``<prefix>.*`` keys.

    A key is looked up in the session as is, then with the ``spark.hadoop.`` prefix, then in the
    Hadoop configuration.  The write-specific
    name key wins over the general one.
    """

    hadoop = spark._jsparkSession.sessionState().newHadoopConf()

    def key(name: str) -> str:
        return name if name == OUTPUT_DIR else f"{prefix}.{name}"

    def look_up(name: str) -> str | None:
        value = spark.conf.get(key(name), None)
        if value is None:
            value = spark.conf.get(HADOOP_PREFIX + key(name), None)
        # Last, what only the Hadoop configuration has (core-site.xml, or set on it at run time).
        return hadoop.get(key(name)) if value is None else value

    def need(value: Any, what: str, *names: str) -> Any:
        for name in names:
            value = look_up(name) if value is None else value
        if value is None or value == "":
            keys = " or ".join(key(name) for name in names)
            raise ValueError(
                f"cannot write: no {what}. Pass it to resolve_config, or set {keys} in the session, "
                f"as it is or after {HADOOP_PREFIX}"
            )
        return value

    shards = need(num_shards, "shard count", NUMBER_OF_SHARDS)
    try:
        shards = int(shards)
    except ValueError:
        raise ValueError(
            f"cannot use {shards!r} of {key(NUMBER_OF_SHARDS)} as shard count: whole numbers >= 1 only"
        ) from None
    return SnapshotConfig(
        output_dir=need(
            output_dir,
            "folder to put the snapshot under",
            OUTPUT_DIR,
        ),
        index_name=need(index_name, "name for the index", RESOURCE_WRITE, RESOURCE),
        mapping=need(mapping, "mapping that declares the fields", MAPPING),
        num_shards=shards,
        id_field=id_field or look_up(ID_FIELD) or DEFAULT_ID_FIELD,
    )


def new_job_id() -> str:
    now = datetime.datetime.now(datetime.timezone.utc)
    return f"job_{now:%Y%m%d%H%M%S}_{secrets.token_hex(6)}"


def snapshot_path(output_dir: str, job_id: str, index_name: str) -> str:
    """``<output>/<job id>/<index>``: where a job puts its snapshot."""
    return "/".join([output_dir.rstrip("/") or "", job_id, index_name])


def _filesystem(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """Whichever Hadoop filesystem a path names, and the path in its terms."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return jvm_path.getFileSystem(conf), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    filesystem, jvm_path = _filesystem(spark, path)
    return filesystem.exists(jvm_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly under a path; none if it does not exist."""
    filesystem, jvm_path = _filesystem(spark, path)
    if not filesystem.exists(jvm_path):
        return []
    return [status.getPath().getName() for status in filesystem.listStatus(jvm_path)]


def path_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below a path."""
    filesystem, jvm_path = _filesystem(spark, path)
    return filesystem.getContentSummary(jvm_path).getLength()


def check_output(spark: SparkSession, path: str, config: SnapshotConfig) -> None:
    """Fail before any work: the settings are complete and the target is new.

    Building ``config`` has already validated the settings.
    """
    if not isinstance(config, SnapshotConfig):
        raise TypeError("config must be a SnapshotConfig")
    if path_exists(spark, path):
        raise FileExistsError(f"path {path} already exists")
