"""Approximate nearest neighbours by cross-polytope hashing.

A table hashes a vector by a pseudo-random rotation (three rounds of random signs and a fast
Hadamard transform) and takes the nearest signed axis of the rotated space.  Small inputs use the
first few axes only, so that buckets stay filled; large ones add a second, smaller polytope, so that
buckets stay small.  A query looks into the ``probes`` nearest buckets of each of ``TABLES`` tables
(multiprobe).  What it meets there is ranked by the exact inner product of the original vectors, in
double precision; each bucket passes on no more than ``k`` for a query.

Largest inner product, not angle: tables hash directions, and the index is cut into bands of similar
length, each with tables for its size, which every query looks into.  A band of up to ``EXACT``
vectors, of whatever lengths, has one bucket.  Queries that meet fewer than ``k`` others are
compared with all vectors.

Work is dealt by (band, table, bucket, part): a bucket of more than ``PART`` vectors is cut into parts,
and its queries visit each, so a hot bucket is no hot task.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take no
part, neither do rows without an id; shorter vectors count as filled up with zeros; of repeated ids
each other id is returned once, with its best score, and a vector never finds its own id; a query
has fewer than ``k`` rows only if there are fewer other ids; ties go to the smaller id; very long
vectors are compared whole; an empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shardloom.llm.common import Query, cut, read, small

K = 20
TABLES = 10
PROBES = 8

#: Vectors in a bucket that a second polytope is added for, and in a part of a bucket.
BUCKET = 1024
PART = 4096

#: Largest ratio of lengths in a band, and vectors in a band that is searched as a whole.
RATIO = 1.2
EXACT = 2048

#: Lengths that overflow count as this one.
LONGEST = float(np.finfo(np.float64).max)

#: Probes grow as the number of vertices of the second polytope to this power.
MORE_PROBES = 0.8


@dataclass(frozen=True)
class Tables:
    """``padded``: dimensions after padding to a power of two; ``first``, ``second``: axes of the
    two polytopes (``second`` may be 0)."""

    padded: int
    first: int
    second: int
    tables: int
    probes: int

    @property
    def buckets(self) -> int:
        return 2 * self.first * max(1, 2 * self.second)

    def _rotated(self, x: np.ndarray, seed: int) -> np.ndarray:
        signs = np.random.default_rng(seed)
        y = np.zeros((len(x), self.padded))
        y[:, : x.shape[1]] = x
        for _ in range(3):
            y = hadamard(y * signs.choice([-1.0, 1.0], self.padded))
        return y

    def _scores(self, x: np.ndarray, table: int) -> np.ndarray:
        """How near each vertex is: vectors by buckets."""
        y = self._rotated(x, 2 * table)[:, : self.first]
        near = np.concatenate([y, -y], axis=1)
        if self.second:
            z = self._rotated(x, 2 * table + 1)[:, : self.second]
            near = (near[:, :, None] + np.concatenate([z, -z], axis=1)[:, None, :]).reshape(len(x), -1)
        return near

    def codes(self, x: np.ndarray, probes: int) -> np.ndarray:
        """``table * buckets + bucket`` of the ``probes`` nearest buckets of every table."""
        found = []
        for table in range(self.tables):
            near = self._scores(x, table)
            if probes == 1:
                best = near.argmax(axis=1)[:, None]
            elif probes >= self.buckets:
                best = np.tile(np.arange(self.buckets), (len(x), 1))
            else:
                best = np.argpartition(-near, probes, axis=1)[:, :probes]
            found.append(best + table * self.buckets)
        return np.concatenate(found, axis=1)


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal fast Walsh-Hadamard transform of each row (a power of two long)."""
    n, half = x.shape[1], 1
    while half < n:
        x = x.reshape(len(x), -1, 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(-1, n)
        half *= 2
    return x / np.sqrt(n)


def _power(n: float) -> int:
    """Largest power of two up to ``n``, 0 if there is none."""
    return 1 << (int(n).bit_length() - 1) if n >= 1 else 0


def plan(n: int, dims: int, tables: int, probes: int) -> Tables:
    padded = 1 << max(dims - 1, 1).bit_length()
    first = min(max(_power(n / 128), 4), padded)
    second = min(_power(n / (2 * first * BUCKET) / 2), padded)
    if second:
        probes = round(probes * (2 * second) ** MORE_PROBES)
    return Tables(padded, first, second, tables, probes)


@dataclass(frozen=True)
class Band:
    """Steps of length from ``begin`` on, up to the next band; ``way`` is None where one bucket
    holds all; codes count from ``offset``."""

    begin: int
    way: Tables | None
    offset: int


def bands(steps: list[tuple[int, int]], dims: int, tables: int, probes: int) -> list[Band]:
    """Bands of ``steps``, ``(step, vectors)`` in order: a step of its own has tables, unless it is
    small; small ones in a row share a bucket."""
    groups: list[list[int]] = []
    for i, (step, n) in enumerate(steps):
        if i and groups[-1][1] + n <= EXACT:
            groups[-1][1] += n
        else:
            groups.append([step, n])
    found, offset = [], 0
    for begin, n in groups:
        # One band of equal lengths is hashed whatever its size.
        way = plan(n, dims, tables, probes) if n > EXACT or len(steps) == 1 else None
        found.append(Band(begin, way, offset))
        offset += way.tables * way.buckets if way else 1
    return found


def stacked(vectors: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims))
    for i, vector in enumerate(vectors):
        out[i, : len(vector)] = vector
    return out


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, embedding, length)`` of the vectors that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    square = F.aggregate(
        F.transform("embedding", lambda x: x.cast("double")), F.lit(0.0), lambda a, x: a + x * x
    )
    return (
        vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
        .select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", F.sqrt(square).alias("length"))
        .where("length > 0")
    )


def _directions(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=0)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _coded(rows: DataFrame, found: list[Band], dims: int, as_query: bool) -> DataFrame:
    """A row for each code: of the own band, for queries of all bands."""

    @F.pandas_udf("array<long>")
    def coded(vectors: pd.Series, steps: pd.Series) -> pd.Series:
        x = _directions(stacked(vectors, dims))
        band_of = np.searchsorted([band.begin for band in found], steps.to_numpy(), side="right") - 1
        codes: list[list[np.ndarray]] = [[] for _ in range(len(x))]
        for number, band in enumerate(found):
            own = np.arange(len(x)) if as_query else np.flatnonzero(band_of == number)
            for i in range(0, len(own), 1024):
                at = own[i : i + 1024]
                if band.way is None:
                    some = np.zeros((len(at), 1), np.int64)
                else:
                    some = band.way.codes(x[at], band.way.probes if as_query else 1)
                for row, code in zip(at.tolist(), some + band.offset, strict=True):
                    codes[row].append(code)
        return pd.Series([np.concatenate(c) for c in codes])

    return rows.select("vec_id", "embedding", F.explode(coded("embedding", "step")).alias("code"))


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest scores, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    tables: int = TABLES,
    probes: int = PROBES,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found for each query row."""
    rows = usable(vectors).withColumn("length", F.least("length", F.lit(LONGEST)))
    seen = rows.agg(F.max(F.size("embedding")).alias("dims"), F.max("length").alias("longest")).first()
    dims, longest = seen["dims"] or 1, seen["longest"] or 1.0
    step = F.floor(F.greatest(F.log(F.lit(longest)) - F.log("length"), F.lit(0.0)) / log(RATIO))
    rows = rows.withColumn("step", step.cast("int"))
    counts = rows.groupBy("step").agg(F.count(F.lit(1)).alias("n")).orderBy("step").collect()
    found_bands = bands([(row["step"], row["n"]) for row in counts], dims, tables, probes)
    indexed = _coded(rows, found_bands, dims, as_query=False)
    queries = rows.where(is_query)
    def rank(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(candidates):
            q, x = stacked(queries["wanted"], dims), stacked(candidates["own"], dims)
            q_ids, ids = queries["query_id"].to_numpy(), candidates["vec_id"].to_numpy()
            # Rows of one id side by side: k different ids are passed on.
            by_id = np.argsort(ids, kind="stable")
            x, ids = x[by_id], ids[by_id]
            firsts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
            for i in range(0, len(q), 256):
                rough = q[i : i + 256] @ x.T
                rough[q_ids[i : i + 256, None] == ids[None, :]] = -np.inf
                if len(firsts) > k:
                    # A margin, as sums differ in their last digits with the order of addition.
                    of_ids = rough if len(firsts) == len(ids) else np.maximum.reduceat(rough, firsts, axis=1)
                    cuts = np.partition(of_ids, len(firsts) - k, axis=1)[:, len(firsts) - k]
                    cuts = cuts - 1e-9 * np.maximum(np.abs(cuts), 1e-300)
                else:
                    cuts = np.full(len(rough), -np.inf)
                for row, (scores, least) in enumerate(zip(rough, cuts, strict=True)):
                    at = np.flatnonzero((scores >= least) & (scores > -np.inf))
                    exact = np.einsum("ij,j->i", x[at], q[i + row])
                    best = best_of(exact, ids[at], len(at))
                    best = best[np.sort(np.unique(ids[at][best], return_index=True)[1])[:k]]
                    found.append((np.full(len(best), q_ids[i + row]), ids[at][best], exact[best]))
        columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [[], [], []]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    def searched(index: DataFrame, asking: DataFrame) -> DataFrame:
        """Best scores of the pairs that meet under a code."""
        parts = small(
            index.groupBy("code").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
        )
        part = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
        index_side = index.join(parts, "code").select(
            F.col("code").alias("in_code"), part.alias("in_part"), F.col("vec_id").alias("vec_id"), F.col("embedding").alias("own")
        )
        every_part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
        query_side = asking.join(parts, "code").select(
            "code", every_part, F.col("vec_id").alias("query_id"), F.col("embedding").alias("wanted")
        )
        return (
            query_side.groupBy("code", "part")
            .cogroup(index_side.groupBy("in_code", "in_part"))
            .applyInPandas(rank, "query_id long, vec_id long, score double")
            .groupBy("query_id", "vec_id")
            .agg(F.max("score").alias("score"))
        )

    met = cut(searched(indexed, _coded(queries, found_bands, dims, as_query=True)))
    # Those with fewer than k others meet all.
    ids = rows.select("vec_id").distinct().count()
    enough = met.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min(k, ids - 1))
    short = small(
        queries.select("vec_id").distinct().join(enough, F.col("vec_id") == F.col("query_id"), "left_anti")
    )
    if short.isEmpty():
        scored = met
    else:
        whole = rows.select("vec_id", "embedding", F.lit(0).cast("long").alias("code"))
        again = searched(whole, queries.select("vec_id", "embedding", F.lit(0).cast("long").alias("code")).join(short, "vec_id"))
        scored = met.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(again)
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        scored.withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES: dict[str, Query] = {"op2_neighbours": op2_neighbours}
ORACLES: dict[str, str] = {}
