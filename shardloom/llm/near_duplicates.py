"""Near duplicates by MinHash and a multi-index Hamming join.

A text is the set of its shingles (``words`` consecutive words).  Equal sets are one node.  A node
has a signature of ``COMPONENTS`` b-bit MinHashes (16 bits each).  The distance of two signatures is
the number of components that differ; texts at the threshold differ by more than the allowed
``distance`` with a chance below ``MISS``.

Index: signatures are cut into ``distance // 2 + 1`` chunks.  Two signatures within the distance
have, by the pigeonhole principle, a chunk with at most one error.  One error is enumerated by
leaving out each component of the chunk in turn: a key is a chunk without one component, and all
pairs within the distance share a key.  None is lost.

A group of nodes that share a key is not expanded into pairs: first every node meets the node of its
group with the most company (the middle of a cluster of copies), links are verified on the full
sets, and groups that are one component by then are done.  Nodes of the other groups meet across
components only, and only if the rare shingles of their sets leave them a chance; such pairs are
verified too, so components are those of all links.

Defined results: null and empty texts, and those without words, have no shingles and no links; texts
with fewer words than a shingle are one shingle; very long texts are compared whole; repeated rows are
rows of one node; rows without an id link like others and have the component's id, which is null if no row
of it has one; ties go to the smallest id; an empty table gives an empty result.  Sets are compared
as 64-bit hashes of shingles.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shardloom.llm.common import Query, columns_of, cut, read, release_memory, small
from shardloom.llm.components import components
from shardloom.llm.grams import mix, run_hashes, word_bounds, word_hashes

COMPONENTS = 64
MISS = 1e-6

#: Words and percent of the contract of the query; stages of pipelines take 5 and 80.
WORDS, PERCENT = 3, 85

_FACTORS = np.random.default_rng(64).integers(1, 1 << 62, COMPONENTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def distance_for(percent: int, n: int = COMPONENTS, miss: float = MISS) -> int:
    """Least distance that sets of ``percent`` similarity exceed with a chance below ``miss``."""
    p, tail = 1 - percent / 100, 1.0
    for t in range(n):
        tail -= comb(n, t) * p**t * (1 - p) ** (n - t)
        if tail < miss:
            return t
    return n


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)
    hashes = word_hashes(data, *word_bounds(data))
    if len(hashes) == 0:
        return hashes
    return np.unique(run_hashes(hashes, min(words, len(hashes))))


def signature(shingles: np.ndarray) -> np.ndarray:
    """16-bit MinHashes of a set that is not empty."""
    least = np.full(COMPONENTS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 4096):
        least = np.minimum(least, (shingles[i : i + 4096, None] * _FACTORS).min(axis=0))
    return (mix(least) >> np.uint64(48)).astype(np.uint16)


def node_of(shingles: np.ndarray) -> int:
    """One number for a set."""
    number = mix(shingles.sum(keepdims=True) + mix(np.array([len(shingles)], np.uint64)))
    return int(number.view(np.int64)[0])


def _keyed(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, text)``: what rows are found again by."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    )


def sketch(docs: DataFrame, words: int) -> DataFrame:
    """``(doc_id, text_hash, n_shingles, node, signature)``; node and signature are null without
    shingles."""

    def sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                found = shingle_set(text, words)
                if len(found):
                    rows.append((len(found), node_of(found), signature(found).tobytes()))
                else:
                    rows.append((0, None, None))
            out = pd.DataFrame(rows, columns=["n_shingles", "node", "signature"])
            out["node"] = out["node"].astype("Int64")
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            out["doc_id"] = out["doc_id"].astype("Int64")
            out.insert(1, "text_hash", batch["text_hash"].to_numpy())
            yield out
        release_memory()

    return _keyed(docs).mapInPandas(
        sketched, "doc_id long, text_hash long, n_shingles long, node long, signature binary"
    )


def _keys(signatures: Column, distance: int) -> Column:
    """Keys of a signature: each chunk without each of its components."""

    @F.pandas_udf("array<long>")
    def keys(values: pd.Series) -> pd.Series:
        s = np.frombuffer(b"".join(values), np.uint16).reshape(-1, COMPONENTS).astype(np.uint64)
        found = []
        for c, chunk in enumerate(np.array_split(np.arange(COMPONENTS), distance // 2 + 1)):
            for left_out in chunk:
                h = np.full(len(s), 1_000 * c + int(left_out) + 1, np.uint64)
                for k in chunk:
                    if k != left_out:
                        h = mix(h + s[:, k])
                found.append(h)
        return pd.Series(list(np.stack(found, axis=1).view(np.int64)))

    return keys(signatures)


def _apart() -> Column:
    """Distance of the signatures ``signature_a`` and ``signature_b``."""

    @F.pandas_udf("int")
    def apart(a: pd.Series, b: pd.Series) -> pd.Series:
        x = np.frombuffer(b"".join(a), np.uint16).reshape(-1, COMPONENTS)
        y = np.frombuffer(b"".join(b), np.uint16).reshape(-1, COMPONENTS)
        return pd.Series((x != y).sum(axis=1).astype(np.int32))

    return apart("signature_a", "signature_b")


def _common() -> Column:
    """Size of the intersection of the sets ``set_a`` and ``set_b``."""

    @F.pandas_udf("long")
    def common(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(
            [
                len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                for x, y in zip(a, b, strict=True)
            ],
            dtype="int64",
        )

    return common("set_a", "set_b")


def _sides(nodes: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    return tuple(
        nodes.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns])
        for side in ("a", "b")
    )


def _meeting(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``texts`` and the ``keys`` of the same id and text."""
    return texts.join(
        keys, (F.col("text_hash") == F.col("of_hash")) & F.col("doc_id").eqNullSafe(F.col("of_id"))
    )


def _sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """``(node, set)`` of the nodes ``wanted``, from their texts.

    A node's text is found by id and hash: rows of one id, or without an id, meet only the nodes of
    their own text.
    """
    keys = small(
        nodes.join(wanted, "node").select(
            F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"), F.col("node").alias("of_node")
        )
    )

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done: set[int] = set()
        for batch in batches:
            rows = []
            for node, text in zip(batch["of_node"].tolist(), batch["text"], strict=True):
                if node in done:
                    continue
                found = shingle_set(text, words)
                # Another text may have the same hash.
                if len(found) and node_of(found) == node:
                    done.add(node)
                    rows.append((node, found.tobytes()))
            yield pd.DataFrame(rows, columns=["node", "set"])
        release_memory()

    return cut(
        _meeting(_keyed(docs), keys)
        .select("of_node", "text")
        .mapInPandas(measured, "node long, set binary")
        .dropDuplicates(["node"])
    )


def _meeting_across(
    open_nodes: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, percent: int
) -> DataFrame:
    """Pairs ``(a, b)`` of open nodes of different components that can be similar enough.

    Shingles of a set are ordered from rare to frequent.  The first one that two sets share leaves
    so many at most to share in either set; both must suffice.  Hence only the first ``100 -
    percent`` percent of a set can hold it, and members of a cluster that differ from its middle by
    too many shingles of their own meet nobody on the shingles of the middle.
    """
    rows = _sets(open_nodes.select("node"), nodes, docs, words).join(open_nodes, "node")

    @F.pandas_udf("array<long>")
    def listed(sets: pd.Series) -> pd.Series:
        return pd.Series([np.frombuffer(x, np.int64) for x in sets])

    place = F.row_number().over(Window.partitionBy("node").orderBy("seen", "shingle"))
    first = (
        rows.select("node", "root", (F.octet_length("set") / 8).cast("long").alias("n"), F.explode(listed("set")).alias("shingle"))
        .withColumn("seen", F.count(F.lit(1)).over(Window.partitionBy("shingle")))
        .withColumn("place", place)
        .where((F.col("place") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1) & (F.col("seen") > 1))
    )
    first = cut(first.select("shingle", "node", "root", "n", "place"))
    x, y = (first.select("shingle", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "root", "n", "place")]) for s in "xy")
    all_of = F.col("n_x") + F.col("n_y")

    def enough(side: str) -> Column:
        return (F.col(f"n_{side}") - F.col(f"place_{side}") + 1) * (100 + percent) >= all_of * percent

    return (
        x.join(y, "shingle")
        .where((F.col("root_x") < F.col("root_y")) & enough("x") & enough("y"))
        .select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b"))
        .distinct()
    )


def verify(
    pairs: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, percent: int, distance: int
) -> DataFrame:
    """Those of ``pairs(a, b)`` whose full sets are similar enough."""
    of_a, of_b = _sides(nodes, "signature", "n")
    ratio = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    near = cut(
        pairs.join(of_a, "a").join(of_b, "b").where(ratio).where(_apart() <= distance).select("a", "b", "n_a", "n_b")
    )
    wanted = near.select(F.col("a").alias("node")).union(near.select(F.col("b").alias("node"))).distinct()
    sets = _sets(wanted, nodes, docs, words)
    set_a, set_b = _sides(sets, "set")
    both = near.join(set_a, "a").join(set_b, "b").withColumn("common", _common())
    return both.where(
        F.col("common") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("common")) * percent
    ).select("a", "b")


def link(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(doc_id, text_hash, n_shingles, node)`` of every row, its distinct nodes each with its smallest id
    and a text of that id, and ``(node, root)`` of linked nodes."""
    distance = distance_for(percent)
    rows = cut(sketch(docs, words))
    nodes = cut(
        rows.where(F.col("node").isNotNull())
        .groupBy("node")
        .agg(
            F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash"))).alias("with_id"),
            F.min("text_hash").alias("text_hash"),
            F.first("n_shingles").alias("n"),
            F.first("signature").alias("signature"),
        )
        .select(
            "node",
            F.col("with_id.doc_id").alias("doc_id"),
            F.coalesce("with_id.text_hash", "text_hash").alias("text_hash"),
            "n",
            "signature",
        )
    )
    by_key = Window.partitionBy("key")
    shared = cut(
        nodes.select("node", F.explode(_keys(F.col("signature"), distance)).alias("key"))
        .withColumn("company", F.count(F.lit(1)).over(by_key))
        .where("company > 1")
    )
    company = shared.groupBy("node").agg(F.sum("company").alias("all_company"))
    middle = F.max(F.struct("all_company", F.negate("node").alias("less"), "node")).over(by_key)
    first = cut(
        shared.join(company, "node")
        .select("node", middle.getField("node").alias("middle"))
        .where("node <> middle")
        .select(F.least("node", "middle").alias("a"), F.greatest("node", "middle").alias("b"))
        .distinct()
    )
    links = cut(verify(first, nodes, docs, words, percent, distance))
    roots = components(links)
    # What still meets across components.
    labelled = shared.select("node", "key").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_nodes = cut(
        labelled.withColumn("low", F.min("root").over(by_key))
        .withColumn("high", F.max("root").over(by_key))
        .where("low < high")
        .select("node", "root")
        .distinct()
    )
    across = cut(
        _meeting_across(open_nodes, nodes, docs, words, percent).join(first, ["a", "b"], "left_anti")
    )
    more = verify(across, nodes, docs, words, percent, distance)
    return rows, nodes, cut(components(links.unionByName(more)))


def _representatives(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """``(node, first_id, first_hash)``: the row that stands for the component of each node.

    It is the one with the smallest id, rows without one last.  There is one row per node here, whatever
    number of rows a node or a component has.
    """
    rooted = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    named = rooted.select("node", "root").join(rooted.groupBy("root").agg(first), "root")
    return named.select("node", F.col("first.doc_id").alias("first_id"), F.col("first.text_hash").alias("first_hash"))


def _named(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows with shingles and what stands for their components, and rows without shingles."""
    rows, nodes, roots = link(docs, words, percent)
    linked = rows.where(F.col("node").isNotNull())
    return linked.join(small(_representatives(nodes, roots)), "node"), rows.where(F.col("node").isNull())


def cluster(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every row."""
    linked, alone = _named(docs, words, percent)
    component = F.coalesce("first_id", "doc_id").alias("component_id")
    every = linked.select("doc_id", "n_shingles", component).unionByName(
        alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    )
    return every.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that with the smallest id.

    Rows are judged by id and text: other texts of the same id stay, rows without an id come last in
    their group, and of equal rows of one id and text one stays (the smallest by a hash of its columns).
    """
    linked, _ = _named(docs, words, percent)
    own = [F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")]
    first = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash"))
    same_row = (F.col("__id").eqNullSafe(F.col("doc_id").cast("bigint"))) & (F.xxhash64("text") == F.col("__hash"))
    gone = small(linked.where(~first).select(*own).distinct())
    left = docs.join(gone, same_row, "left_anti")
    again = small(linked.where(first).groupBy(*own).agg(F.count(F.lit(1)).alias("__rows")).where("__rows > 1"))
    # Only rows that repeat an id and a text are compared with each other, one per map task.
    equal = left.join(again, same_row, "left_semi")
    order = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.xxhash64(*columns_of(docs)))
    one = equal.withColumn("__place", F.row_number().over(order)).where(F.col("__place") == 1)
    single = left.join(again, same_row, "left_anti").select(columns_of(docs))
    return single.unionByName(one.select(columns_of(docs)))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {"op4_near_duplicates": op4_near_duplicates}
ORACLES: dict[str, str] = {}
