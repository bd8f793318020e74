"""Read a snapshot back: its manifest, its documents, and searches over them."""

from __future__ import annotations

import json
from functools import cached_property, reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardloom.config import path_bytes, path_exists
from shardloom.functions.tokens import query_terms
from shardloom.mapping import stored_fields, text_fields, text_paths
from shardloom.operators.routing import verify_routing
from shardloom.operators.search import DEFAULT_SIZE, match_query
from shardloom.plans.scratch import scratch_dir
from shardloom.plans.search_tables import (
    generation_path,
    read_postings,
    read_stats,
    read_terms,
    slices_for,
    write_postings,
)
from shardloom.plans.write import (
    ZONES_SCHEMA,
    digest_of,
    docs_path,
    docs_schema,
    manifest_path,
    part_of,
    zones_path,
)

# Texts of any length, or an error: a text that cannot be parsed must not look like none.
PARSER = {"mode": "FAILFAST", "maxStringLen": str(2**31 - 1), "maxNumLen": str(2**31 - 1)}

# Hits of a page whose ids are pushed into the scan, and ids per pushed list.
SHORT_PAGE = 1000
PUSHED_IDS = 10

MANIFEST_SCHEMA = (
    "index_name string, index_uuid string, snapshot string, generation int, num_shards int, "
    "num_routing_shards int, num_replicas int, id_field string, mapping string, "
    "shard int, doc_count bigint"
)


class MissingManifestError(FileNotFoundError):
    """The directory holds no committed snapshot."""


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per shard; a directory without a committed manifest is an error."""
    if not path_exists(spark, f"{manifest_path(path)}/_SUCCESS"):
        raise MissingManifestError(
            f"no snapshot manifest under {path}: did the job that writes it complete?"
        )
    return spark.read.schema(MANIFEST_SCHEMA).json(manifest_path(path))


def restore(spark: SparkSession, path: str) -> DataFrame:
    """``(_id, source, fields, shard)`` of a snapshot; see ``Snapshot.documents``."""
    return Snapshot(spark, path).documents()


def open_snapshot(spark: SparkSession, path: str) -> Snapshot:
    return Snapshot(spark, path)


class Snapshot:
    """A committed snapshot.

    Methods return DataFrames and run no job of their own, except that the manifest is read and
    that searches find the ids of their page first.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self._shards  # fail early if there is no manifest

    @cached_property
    def _shards(self) -> list[Row]:
        """Manifest rows in shard order: as many as there are shards."""
        rows = read_manifest(self.spark, self.path).orderBy("shard").collect()
        if not rows or [row["shard"] for row in rows] != list(range(rows[0]["num_shards"])):
            raise MissingManifestError(f"the snapshot manifest under {self.path} is incomplete")
        return rows

    @property
    def index_name(self) -> str:
        return self._shards[0]["index_name"]

    @property
    def num_shards(self) -> int:
        return self._shards[0]["num_shards"]

    @property
    def mapping(self) -> dict[str, Any]:
        return json.loads(self._shards[0]["mapping"])

    def manifest(self) -> DataFrame:
        return read_manifest(self.spark, self.path)

    def stored_documents(self) -> DataFrame:
        """The stored columns only; ``fields`` is missing if all declared fields are text."""
        schema = docs_schema(self.mapping)
        return self.spark.read.schema(schema).parquet(docs_path(self.path))

    def documents(self) -> DataFrame:
        """``(_id, source, fields, lists, shard)`` with all declared fields in ``fields``.

        ``fields`` has the only or first value of a field, ``lists`` all values of a field that has
        several (NULL otherwise); ``values`` gives either as a list.  Text fields are taken from the
        source when, and only when, they are used.  A mapping that lets fields leave out malformed
        values adds ``ignored``, the paths of those that did.
        """
        mapping = self.mapping
        texts = [T.StructField(name, T.StringType()) for name in text_fields(mapping)]
        parsed = F.from_json("source", T.StructType(texts), PARSER) if texts else None
        fields = [
            F.col("fields").getField(field.name).alias(field.name)
            for field in stored_fields(mapping).fields
        ] + [
            F.coalesce(F.get(F.col("lists").getField(field.name), F.lit(0)), parsed.getField(field.name)).alias(field.name)
            for field in texts
        ]
        stored = self.stored_documents()
        more = [name for name in ("lists", "ignored") if name in stored.columns]
        return stored.select(
            "_id", "source", *([F.struct(*fields).alias("fields")] if fields else []), *more, "shard"
        )

    def values(self, name: str) -> Column:
        """All values of a field, named by dotted path, as a list; a column of ``documents()``."""
        one, several = F.col("fields"), F.col("lists")
        for part in name.split("."):
            one, several = one.getField(part), several.getField(part)
        return F.coalesce(several, F.array_compact(F.array(one)))

    def match_all(self, size: int = DEFAULT_SIZE) -> DataFrame:
        """The first ``size`` hits by shard and id, all with score 1.

        The manifest tells which shards fill the page.  Of the last of them the ids that the zones
        bound are looked at for the one that ends the page; then exactly the page is read.
        """
        shard, stored = F.col("shard"), self.stored_documents()
        before, last = 0, None
        for row in self._shards:
            if before + row["doc_count"] >= size:
                last = row["shard"]
                break
            before += row["doc_count"]
        # Two scans: a condition on both shard and id would not reach the files.
        scans = [stored if last is None else stored.where(shard < last)] if last != 0 else []
        if last is not None:
            end = self._id_at(last, size - before)
            scans.append(stored.where((shard == last) & (F.lit(False) if end is None else F.col("_id") <= end)))
        hits = [scan.select("shard", "_id", F.lit(1.0).alias("_score"), "source") for scan in scans]
        return self._ordered(reduce(DataFrame.unionByName, hits), size, "shard", "_id").drop("shard")

    def _id_at(self, shard: int, rank: int) -> str | None:
        """The id of a shard that ``rank`` ids do not exceed; None for none."""
        if rank <= 0:
            return None
        of_shard = F.col("shard") == shard
        known = []
        for zone in self.zones().where(of_shard).select("ranks").collect():
            ranks = zone["ranks"]
            # Up to an id there are as many more as there are from the rank before it.
            known += [(r["_id"], r["rank"] - (ranks[i - 1]["rank"] if i else -1)) for i, r in enumerate(ranks)]
        bound, seen = None, 0
        for doc_id, more in sorted(known, key=lambda pair: pair[0].encode()):
            seen += more
            if seen >= rank:
                bound = doc_id
                break
        ids = self.stored_documents().where(of_shard).select("_id")
        ids = ids if bound is None else ids.where(F.col("_id") <= bound)
        return ids.orderBy("_id").limit(rank).agg(F.max("_id")).first()[0]

    def zones(self) -> DataFrame:
        """One row per stored file; see ``shardloom.plans.write.zones_of``."""
        return self.spark.read.schema(ZONES_SCHEMA).json(zones_path(self.path))

    def _ordered(self, hits: DataFrame, size: int, *order: Column | str) -> DataFrame:
        """``(shard, _index, _id, _score, _source)`` in order, without reading documents twice: a short
        page is sorted by one task, a long one is stored before it is sorted."""
        named = hits.select(
            "shard", F.lit(self.index_name).alias("_index"), "_id", "_score", F.col("source").alias("_source")
        )
        if size <= SHORT_PAGE:
            return named.coalesce(1).sortWithinPartitions(*order)
        path = scratch_dir(self.spark)
        named.write.parquet(path)
        return self.spark.read.schema(named.schema).parquet(path).orderBy(*order)

    def _fetch(self, page: DataFrame, size: int) -> DataFrame:
        """``(shard, _id, _score, source)`` of the hits on a page.

        A page, of whatever size was asked for, is written to the shared folder first (ids and
        scores only).  Its ids tell the parts of the shards that hold them, and only those are read: their
        names come to the driver, at most as many as there are parts.  The ids of a short page also go
        into the scan, which leaves out row groups by Bloom filter and pages by their range of ids.
        """
        path = scratch_dir(self.spark)
        page.write.parquet(path)
        page = self.spark.read.schema(page.schema).parquet(path)
        parts = self.zones().limit(1).select("num_parts").first()
        name = F.concat_ws("/", "shard", part_of(F.col("_id"), parts[0] if parts else 1))
        wanted = [row[0] for row in page.select(name).distinct().collect()]
        stored = self.stored_documents().where(F.concat_ws("/", "shard", "part").isin(wanted))
        if size <= SHORT_PAGE:
            ids = [row["_id"] for row in page.select("_id").collect()]
            # Longer lists are not compared with Bloom filters.
            some = [F.col("_id").isin(ids[i : i + PUSHED_IDS]) for i in range(0, len(ids), PUSHED_IDS)]
            while len(some) > 1:
                some = [some[i] | some[i + 1] if i + 1 < len(some) else some[i] for i in range(0, len(some), 2)]
            stored = stored.where(some[0] if some else F.lit(False))
        return stored.select("shard", "_id", "source").join(F.broadcast(page) if size <= SHORT_PAGE else page, ["shard", "_id"])

    def total_hits(self) -> DataFrame:
        """One row ``(value, relation)``; counted from the stored files, hence exact."""
        return (
            self.stored_documents()
            .agg(F.count(F.lit(1)).alias("value"))
            .withColumn("relation", F.lit("eq"))
        )

    def shards_summary(self, contents: bool = False) -> DataFrame:
        """``(total, successful, skipped, failed)``: a shard fails if its files do not hold as
        many documents as the manifest says; with ``contents``, also if they are not the ones that were
        written, for which all documents are read."""
        stored = self.stored_documents()
        found = stored.groupBy("shard").agg(F.count(F.lit(1)).alias("stored"))
        ok = F.coalesce("stored", F.lit(0)) == F.col("doc_count")
        shards = self.manifest().join(found, "shard", "left")
        if contents:
            total = F.sum(digest_of(F.col("_id"), F.col("source")).cast("decimal(38,0)"))
            now = stored.groupBy("shard").agg(total.alias("now"))
            then = self.zones().groupBy("shard").agg(F.sum("digest").alias("then"))
            shards = shards.join(now, "shard", "left").join(then, "shard", "left")
            ok = ok & F.col("now").eqNullSafe(F.col("then"))
        return shards.agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(ok).alias("successful"),
            F.lit(0).cast("bigint").alias("skipped"),
            F.count_if(~ok).alias("failed"),
        )

    def get_mapping(self) -> DataFrame:
        """One row ``(index_name, mapping)``."""
        return self.manifest().where("shard = 0").select("index_name", "mapping")

    def index_metadata(self) -> DataFrame:
        """One row of what holds for the whole index."""
        return (
            self.manifest()
            .groupBy("index_name", "snapshot", "generation", "num_shards", "num_routing_shards",
                     "num_replicas")
            .agg(F.sum("doc_count").alias("doc_count"))
        )

    def verify_routing(self) -> DataFrame:
        """Documents stored in another shard than that of their id; empty if all is well."""
        return verify_routing(
            self.stored_documents().select("_id", "shard"), self.num_shards
        )

    def write_search_tables(self, *fields: str, unicode_words: bool = False) -> None:
        """Build the postings of text fields, named by dotted path (all of them by default).

        ``unicode_words`` chooses what a word is, see ``shardloom.functions.tokens``; searches follow it.
        """
        declared = text_paths(self.mapping)
        unknown = [field for field in fields if field not in declared]
        if unknown:
            raise ValueError(f"not declared as text fields: {', '.join(unknown)}")
        size = path_bytes(self.spark, docs_path(self.path))
        slices = slices_for(self.spark, self.num_shards, size)
        for field in fields or declared:
            # The values of a text are one text, one after the other.
            text = F.array_join(self.values(".".join(declared[field])), "\n").alias(field)
            docs = self.documents().select("shard", "_id", text)
            write_postings(docs, self.path, field, self.num_shards, slices, unicode_words)

    def postings(self, field: str) -> DataFrame:
        return read_postings(self.spark, generation_path(self.spark, self.path, field))

    def term_dictionary(self, field: str) -> DataFrame:
        """``(term, doc_freq, total_tf)`` as stored beside the postings."""
        return read_terms(self.spark, generation_path(self.spark, self.path, field))

    def match(self, field: str, text: str, size: int = DEFAULT_SIZE) -> DataFrame:
        """The ``size`` best hits for any word of ``text``, as ``match_all`` returns them.

        Needs the search tables of the field.
        """
        generation = generation_path(self.spark, self.path, field)
        stats = read_stats(self.spark, generation)
        built = stats.first()
        slices, terms = built["slices"], query_terms(self.spark, text, built["unicode_words"])
        post = read_postings(self.spark, generation, terms, slices)
        best = match_query(post, stats, terms, size, read_terms(self.spark, generation, terms, slices))
        return self._ordered(self._fetch(best, size), size, F.desc("_score"), "_id").drop("shard")
