"""Search tables of a snapshot: the postings of a text field, laid out for lookups by term.

Layout below ``<snapshot>/search/<field>/<generation>``::

    postings/shard=<k>/slice=<s>/*.parquet   sorted by term; a term has one slice per shard
    terms/slice=<s>/*.parquet                the term dictionary, sorted by term
    stats/*.json                             one row; its presence makes the generation complete

A build makes a new generation and writes its totals last; readers take the newest complete one.  So a
build that fails, or is repeated, neither blocks nor disturbs anything.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.config import child_names, path_exists
from shardloom.operators.postings import postings, term_dictionary, with_average
from shardloom.operators.routing import parts_per_shard, spread

# Fixed value: bytes of documents per slice of a shard.
SLICE_BYTES = 64 << 20

POSTINGS_SCHEMA = (
    "term string, _id string, tf int, positions array<int>, doc_len int, is_first boolean, "
    "shard int, slice int"
)
TERMS_SCHEMA = "term string, doc_freq bigint, total_tf bigint, slice int"
STATS_SCHEMA = (
    "doc_count bigint, sum_tokens bigint, avg_len double, slices int, unicode_words boolean"
)


def field_path(path: str, field: str) -> str:
    return f"{path}/search/{quote(field, safe='')}"


def slice_of(term: Column, slices: int) -> Column:
    return F.pmod(F.hash(term), F.lit(slices))


def slices_for(spark: SparkSession, num_shards: int, docs_bytes: int) -> int:
    """Slices per shard: one for each ``SLICE_BYTES`` of documents, but no more than the parts
    that fill the shuffle partitions."""
    wanted = -(-docs_bytes // (num_shards * SLICE_BYTES))
    return max(1, min(wanted, parts_per_shard(spark, num_shards)))


def new_generation() -> str:
    """A name that sorts after those of earlier builds."""
    return f"g{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def write_postings(
    docs: DataFrame,
    path: str,
    field: str,
    num_shards: int,
    slices: int = 1,
    unicode_words: bool = False,
) -> None:
    """Write the postings of ``field`` of ``(shard, _id, <field>)`` documents, then the terms, then
    the totals.

    One shuffle of postings: by shard and a hash of the term, of which the slice is the remainder.
    There are as many parts as it takes to fill the shuffle partitions even if there is one slice, and
    adaptive execution cuts the part of a frequent term into several tasks.  Terms and totals are
    counted from narrow columns of what was written.
    """
    spark = docs.sparkSession
    target = f"{field_path(path, field)}/{new_generation()}"
    parts = slices * max(1, parts_per_shard(spark, num_shards) // slices)
    sliced = postings(docs, field, unicode_words=unicode_words).withColumn("slice", slice_of(F.col("term"), slices))
    (
        spread(sliced, num_shards, slice_of(F.col("term"), parts))
        .sortWithinPartitions("shard", "slice", "term", "_id")
        .withColumn("is_first", F.get("positions", F.lit(0)) == 0)
        .select("term", "_id", "tf", "positions", "doc_len", "is_first", "shard", "slice")
        .write.mode("errorifexists")
        .partitionBy("shard", "slice")
        .parquet(f"{target}/postings")
    )
    stored = spark.read.schema(POSTINGS_SCHEMA).parquet(f"{target}/postings")
    terms = term_dictionary(stored).withColumn("slice", slice_of(F.col("term"), slices))
    (
        terms.sortWithinPartitions("slice", "term")
        .write.mode("errorifexists")
        .partitionBy("slice")
        .parquet(f"{target}/terms")
    )
    # Each document has one posting that holds its first token.
    stats = stored.agg(
        F.count_if("is_first").alias("doc_count"), F.coalesce(F.sum("tf"), F.lit(0)).alias("sum_tokens")
    )
    stats = with_average(stats).withColumn("slices", F.lit(slices))
    stats = stats.withColumn("unicode_words", F.lit(unicode_words))
    stats.coalesce(1).write.mode("errorifexists").json(f"{target}/stats")


def generation_path(spark: SparkSession, path: str, field: str) -> str:
    """The newest complete generation of a field's tables."""
    base = field_path(path, field)
    for name in sorted(child_names(spark, base), reverse=True):
        if path_exists(spark, f"{base}/{name}/stats/_SUCCESS"):
            return f"{base}/{name}"
    raise FileNotFoundError(f"no search tables for field {field} under {path}: write them first")


def read_stats(spark: SparkSession, generation: str) -> DataFrame:
    """One row ``(doc_count, sum_tokens, avg_len, slices, unicode_words)``."""
    return spark.read.schema(STATS_SCHEMA).json(f"{generation}/stats")


def _of_terms(stored: DataFrame, terms: Sequence[str] | None, slices: int) -> DataFrame:
    """With ``terms``, only the slices and row groups that can hold them."""
    if terms is not None:
        wanted = F.lit(False)
        for term in terms:
            wanted = wanted | (F.col("slice") == slice_of(F.lit(term), slices))
        stored = stored.where(wanted & F.col("term").isin(list(terms)))
    return stored.drop("slice")


def read_postings(
    spark: SparkSession, generation: str, terms: Sequence[str] | None = None, slices: int = 1
) -> DataFrame:
    """Stored postings, of ``terms`` only if given."""
    stored = spark.read.schema(POSTINGS_SCHEMA).parquet(f"{generation}/postings")
    return _of_terms(stored.drop("is_first"), terms, slices)


def read_terms(
    spark: SparkSession, generation: str, terms: Sequence[str] | None = None, slices: int = 1
) -> DataFrame:
    """The stored term dictionary ``(term, doc_freq, total_tf)``, of ``terms`` only if given."""
    stored = spark.read.schema(TERMS_SCHEMA).parquet(f"{generation}/terms")
    return _of_terms(stored, terms, slices)
