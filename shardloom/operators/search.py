"""Ranked search over postings with BM25 (Robertson and Zaragoza, 2009)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The usual BM25 parameters, the default page of a search.
K1 = 1.2
B = 0.75
DEFAULT_SIZE = 10

SCORE = "decimal(18,6)"


def score_matches(
    post: DataFrame, stats: DataFrame, terms: Sequence[str], dictionary: DataFrame | None = None
) -> DataFrame:
    """``(shard, _id, _score)`` of every document that holds at least one of the terms.

    ``stats`` is the one-row result of ``field_stats``; statistics are global, so scores do not
    depend on the number of shards.  With a ``dictionary`` of ``(term, doc_freq)`` postings are read once, else
    also to count documents per term.  A term's share is rounded before it is added, which makes
    the sum exact and independent of the order of addition.
    """
    hits = post.where(F.col("term").isin(list(terms))).select(
        "shard", "_id", "term", "tf", "doc_len"
    )
    totals = stats.select(F.struct("doc_count", "avg_len")).scalar()
    # At most one row per query term: small enough to send to every task.
    if dictionary is None:
        counts = hits.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    else:
        counts = dictionary.where(F.col("term").isin(list(terms))).select("term", F.col("doc_freq").alias("df"))
    weights = (
        counts.select("term", "df", totals.alias("totals"))
        .select(
            "term",
            F.col("totals.avg_len").alias("avg_len"),
            F.ln(1 + (F.col("totals.doc_count") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias(
                "idf"
            ),
        )
    )
    tf = F.col("tf").cast("double")
    length_norm = K1 * (1 - B + B * F.col("doc_len") / F.col("avg_len"))
    share = (F.col("idf") * tf / (tf + length_norm)).cast(SCORE)
    return (
        hits.join(F.broadcast(weights), "term")
        .groupBy("shard", "_id")
        .agg(F.sum(share).cast("double").alias("_score"))
    )


def match_query(
    post: DataFrame,
    stats: DataFrame,
    terms: Sequence[str],
    size: int = DEFAULT_SIZE,
    dictionary: DataFrame | None = None,
) -> DataFrame:
    """The ``size`` best documents, ``(shard, _id, _score)``; ties in order of ``_id``."""
    return score_matches(post, stats, terms, dictionary).orderBy(F.desc("_score"), "_id").limit(size)
