from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from murmur import murmur3, routing_hash
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import shardloom as sl
from shardloom.functions.hashing import int_hashing_to
from shardloom.operators.routing import parts_per_shard, spread


def frame(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "_id string")


def hashes(spark, ids):
    rows = sl.with_routing_hash(frame(spark, ids)).collect()
    return {row["_id"]: row["hash"] for row in rows}


def test_plain_murmur_known_values():
    # Published test vectors of the algorithm.
    assert murmur3(b"") == 0
    assert murmur3(b"", 1) == 0x514E28B7
    assert murmur3(b"test") == 0xBA6BD213 - (1 << 32)
    assert murmur3(b"Hello, world!") == 0xC0363E43 - (1 << 32)


def test_shards_of_known_ids(spark):
    routed = sl.with_shard(frame(spark, ["id1", "id2", "id3"]), 2)
    assert {r["_id"]: r["shard"] for r in routed.collect()} == {"id1": 1, "id2": 1, "id3": 0}


def test_hash_of_known_ids(spark):
    assert hashes(spark, ["id1", "id2", "id3"]) == {
        "id1": 1444213517,
        "id2": -1971053850,
        "id3": 1247970566,
    }


@pytest.mark.parametrize(
    ("shards", "routing"),
    [(1, 1024), (2, 1024), (3, 768), (5, 640), (32, 1024), (512, 1024), (1024, 2048), (1025, 2050)],
)
def test_num_routing_shards(shards, routing):
    assert sl.num_routing_shards(shards) == routing


@pytest.mark.parametrize("shards", [0, -1])
def test_num_routing_shards_refuses(shards):
    with pytest.raises(ValueError, match="number of shards"):
        sl.num_routing_shards(shards)


def test_hash_of_odd_ids(spark):
    ids = ["", "é", "日本", "𝄞", "𝄞x", "a" * 101, "a" * 100, " ", "x\ty"]
    assert hashes(spark, ids) == {i: routing_hash(i) for i in ids}


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(ids=st.lists(st.text(max_size=40), min_size=200, max_size=400, unique=True))
def test_hash_equals_plain_murmur(spark, ids):
    assert hashes(spark, ids) == {i: routing_hash(i) for i in ids}


@pytest.mark.parametrize("shards", [1, 2, 3, 7, 64, 1000])
def test_shard_in_range_and_from_hash(spark, shards):
    routing = sl.num_routing_shards(shards)
    ids = [f"key-{i}" for i in range(500)]
    for row in sl.with_shard(frame(spark, ids), shards).collect():
        assert row["shard"] == routing_hash(row["_id"]) % routing // (routing // shards)
        assert 0 <= row["shard"] < shards


@pytest.mark.parametrize(("count", "first", "split"), [(1000, 0, [495, 505]), (10000, 1, [5011, 4989])])
def test_split_of_consecutive_ids(spark, count, first, split):
    ids = spark.range(first, first + count).select(F.concat(F.lit("id"), "id").alias("_id"))
    counts = sl.shard_counts(sl.with_shard(ids, 2), 2).orderBy("shard").collect()
    assert [row["doc_count"] for row in counts] == split


def test_hash_ignores_session_ansi_mode(spark):
    ids = ["id1", "id2", "日本語", "abcd"]
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert hashes(spark, ids) == {i: routing_hash(i) for i in ids}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_int_hashing_to(spark):
    values = [0, 1, 7, 1999, -1, 2**31 - 1, -(2**31)]
    keys = spark.createDataFrame([(v, int_hashing_to(v)) for v in values], "v int, k int")
    assert keys.where("hash(k) <> v").count() == 0


@pytest.mark.parametrize("shards", [1, 3, 8, 50])
def test_spread_fills_all_partitions_evenly(spark, shards):
    """Without adaptive execution each partition holds its share and no part is torn."""
    routed = sl.with_shard(frame(spark, [f"id{i}" for i in range(4000)]), shards)
    part = F.pmod(F.xxhash64("_id"), F.lit(parts_per_shard(spark, shards))).cast("int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        placed = spread(routed.withColumn("part", part), shards, F.col("part"))
        rows = placed.select("shard", "part", F.spark_partition_id().alias("p")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = Counter(row["p"] for row in rows)
    assert len(rows) == 4000 and len(sizes) == 8
    assert max(sizes.values()) < 1.9 * min(sizes.values()) or shards == 3
    homes = {}
    for row in rows:
        homes.setdefault((row["shard"], row["part"]), set()).add(row["p"])
    assert all(len(home) == 1 for home in homes.values())


def test_with_shard_keeps_other_columns(spark):
    df = spark.createDataFrame([("id1", 5, "x")], "_id string, `a.b` int, hash string")
    row = sl.with_shard(df, 2).first()
    assert row.asDict() == {"_id": "id1", "a.b": 5, "hash": "x", "shard": 1}


def test_filter_on_shard_is_not_pushed_into_the_hash(spark):
    routed = sl.with_shard(frame(spark, ["id1", "id2"]), 2).where("shard = 1 and shard is not null")
    plan = routed._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 8000
    assert routed.count() == 2


def test_hash_stays_in_compiled_code(spark):
    ids = spark.range(10).select(F.col("id").cast("string").alias("_id"))
    plan = sl.with_shard(ids, 4)._jdf.queryExecution().executedPlan().toString()
    assert all(line.lstrip(" +-").startswith("*(1)") for line in plan.strip().splitlines())


def test_partition_index_is_shard(spark):
    routed = sl.with_shard(frame(spark, [f"id{i}" for i in range(300)]), 16)
    parts = sl.partition_by_shard(routed, 16)
    rows = sl.partition_counts(parts).collect()
    assert all(row["shard"] == row["partition"] for row in rows)
    assert sum(row["n_rows"] for row in rows) == 300
    assert sl.check_partition_count(parts, 16) is parts


def test_partition_count_mismatch(spark):
    parts = sl.partition_by_shard(sl.with_shard(frame(spark, ["id1"]), 4), 4)
    with pytest.raises(ValueError, match=r"partitions \(4\) must equal the number of shards \(5\)"):
        sl.check_partition_count(parts, 5)


@pytest.mark.parametrize("shard", [None, -1, 4])
def test_partition_by_shard_refuses_other_shards(spark, shard):
    df = spark.createDataFrame([("a", shard)], "_id string, shard int")
    with pytest.raises(PySparkException, match="shard out of range"):
        sl.partition_by_shard(df, 4).collect()


def test_shard_counts_has_empty_shards(spark):
    routed = sl.with_shard(frame(spark, ["id1", "id2", "id3"]), 16)
    rows = sl.shard_counts(routed, 16).collect()
    assert sorted(row["shard"] for row in rows) == list(range(16))
    assert sum(row["doc_count"] for row in rows) == 3
    assert sum(row["doc_count"] == 0 for row in rows) >= 13


def test_verify_routing_finds_misplaced_rows(spark):
    df = spark.createDataFrame([("id1", 1), ("id2", 0), ("id3", None)], "_id string, shard int")
    wrong = {r["_id"]: r["expected_shard"] for r in sl.verify_routing(df, 2).collect()}
    assert wrong == {"id2": 1, "id3": 0}


def test_column_names_with_backticks(spark):
    df = spark.range(3).selectExpr("concat('id', id) as `a``b`", "id as `x.y`")
    assert sl.with_shard(df, 2, "a`b").columns == ["a`b", "x.y", "shard"]


def test_keys_of_many_partitions_cost_little(spark):
    import time

    from shardloom.operators.routing import spread

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "20000")
    try:
        start = time.time()
        spread(spark.range(1).selectExpr("0 as shard"), 2, F.lit(0))
        assert time.time() - start < 5
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
