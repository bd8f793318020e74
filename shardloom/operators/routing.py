"""Which shard a document belongs to, and how rows get there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.functions.hashing import (
    int_hashing_to,
    num_routing_shards,
    routing_shift,
    with_routing_hash,
)

_HASH = "__route_hash"


def with_shard(
    df: DataFrame, num_shards: int, id_column: str = "_id", output: str = "shard"
) -> DataFrame:
    """Add the shard of ``id_column`` as INT column ``output``.

    A virtual shard is picked by the hash; since each shard owns a power of two of them,
    the shard is a shift away.
    """
    virtual = F.pmod(F.col(_HASH), F.lit(num_routing_shards(num_shards)))
    shard = F.shiftright(virtual, routing_shift(num_shards))
    return (
        with_routing_hash(df, id_column, _HASH).withColumn(output, shard.cast("int")).drop(_HASH)
    )


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def parts_per_shard(spark: SparkSession, num_shards: int) -> int:
    """How many parts of each shard it takes to fill the configured shuffle partitions."""
    return max(1, -(-shuffle_partitions(spark) // num_shards))


def spread(
    df: DataFrame, num_shards: int, part: Column, shard_column: str = "shard", split: bool = True
) -> DataFrame:
    """Rows shuffled by shard and part of a shard, ``part`` being below ``parts_per_shard``.

    So the number of shards does not set the number of tasks.  Parts are dealt out to shuffle
    partitions in turn, which hashing them would not do: each gets a key that Spark hashes to
    the number of its partition.  The shuffle is a rebalancing one, so adaptive execution cuts
    a partition that is larger than the advisory size and packs small ones together; without
    adaptive execution, for which Spark ignores that hint, it is a plain one.  Should Spark ever
    hash otherwise, only the balance of the tasks would change.

    Without ``split`` all rows of a part stay in one task, and the key is kept as ``__turn``.
    """
    spark = df.sparkSession
    partitions = shuffle_partitions(spark)
    turn = F.col(shard_column) * parts_per_shard(spark, num_shards) + part
    # One literal text, split once when the plan is optimized: thousands of literals take seconds.
    keys = F.split(F.lit(" ".join(str(int_hashing_to(n)) for n in range(partitions))), " ")
    key = F.get(keys, F.pmod(turn, F.lit(partitions))).cast("int")
    keyed = df.withColumn("__turn", key)
    if not split:
        return keyed.repartition("__turn")
    if spark.conf.get("spark.sql.adaptive.enabled") == "true":
        shuffled = keyed.hint("rebalance", partitions, "__turn")
    else:
        shuffled = keyed.repartition(partitions, "__turn")
    return shuffled.drop("__turn")


def partition_by_shard(df: DataFrame, num_shards: int, shard_column: str = "shard") -> DataFrame:
    """Exactly ``num_shards`` partitions; the index of a partition is the shard it holds.

    For consumers that need one task per shard.  The snapshot writer does not: it lets
    adaptive execution cut large shards into several tasks.
    """
    shard = F.col(shard_column)
    message = F.concat(F.lit("shard out of range: "), F.coalesce(shard.cast("string"), F.lit("null")))
    checked = F.when((shard >= 0) & (shard < num_shards), shard).otherwise(
        F.raise_error(message).cast("int")
    )
    return df.repartitionById(num_shards, checked)


def partition_counts(df: DataFrame, shard_column: str = "shard") -> DataFrame:
    """Rows of each shard in each partition of ``df``."""
    return df.groupBy(
        F.col(shard_column).alias("shard"), F.spark_partition_id().alias("partition")
    ).agg(F.count(F.lit(1)).alias("n_rows"))


def check_partition_count(df: DataFrame, num_shards: int) -> DataFrame:
    """``df`` itself, if its plan has one partition per shard; raises otherwise.

    The number is read from the plan: nothing is run.
    """
    actual = df._jdf.queryExecution().sparkPlan().outputPartitioning().numPartitions()
    if actual != num_shards:
        raise ValueError(
            f"the number of partitions ({actual}) must equal the number of shards ({num_shards})"
        )
    return df


def snapshot_skeleton(spark: SparkSession, num_shards: int) -> DataFrame:
    """All shards ``0 .. num_shards - 1`` as INT column ``shard``."""
    return spark.range(num_shards).select(F.col("id").cast("int").alias("shard"))


def with_empty_shards(counts: DataFrame, num_shards: int) -> DataFrame:
    """Per-shard ``doc_count`` rows completed with 0 for shards that have none.

    At most one row per shard on either side, whatever the size of the data.
    """
    return (
        snapshot_skeleton(counts.sparkSession, num_shards)
        .join(counts, "shard", "left")
        .withColumn("doc_count", F.coalesce("doc_count", F.lit(0).cast("bigint")))
    )


def shard_counts(
    df: DataFrame, num_shards: int, shard_column: str = "shard"
) -> DataFrame:
    """``(shard, doc_count)``, empty shards included: the skew view."""
    counts = df.groupBy(F.col(shard_column).alias("shard")).agg(
        F.count(F.lit(1)).alias("doc_count")
    )
    return with_empty_shards(counts, num_shards)


def verify_routing(
    df: DataFrame, num_shards: int, id_column: str = "_id", shard_column: str = "shard"
) -> DataFrame:
    """Rows that are not in the shard of their id, with the shard they belong to."""
    return with_shard(df, num_shards, id_column, "expected_shard").where(
        ~F.col(shard_column).eqNullSafe(F.col("expected_shard"))
    )
