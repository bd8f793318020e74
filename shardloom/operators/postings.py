"""Inverted index tables of one text field.

A posting is ``(shard, term, _id, tf, positions, doc_len)``.  All tokens of a document are in
one row, so its postings are made inside that row: tokens are sorted with their positions and
each run of equal terms is cut out.  No shuffle is needed to group them, and a hot term costs
nothing here because terms of different documents never meet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.functions.tokens import token_array
from shardloom.operators.documents import column


def postings(
    docs: DataFrame,
    field: str = "text",
    id_column: str = "_id",
    shard_column: str = "shard",
    unicode_words: bool = False,
) -> DataFrame:
    """``(shard, term, _id, tf, positions, doc_len)``; ``positions`` ascend from 0."""
    keys = [F.col(shard_column).alias("shard"), F.col(id_column).alias("_id")]
    located = F.transform(
        token_array(column(field), unicode_words),
        lambda term, position: F.struct(term.alias("term"), position.alias("position")),
    )
    tokens, starts, length = F.col("__tokens"), F.col("__starts"), F.col("doc_len")

    # Each step is a projection of its own, so that lambdas refer to a computed array instead
    # of computing it again per element.
    in_order = docs.select(*keys, F.sort_array(located).alias("__tokens"))
    sized = in_order.withColumn("doc_len", F.size(tokens))
    first_of_run = F.filter(
        F.sequence(F.lit(0), length - 1),
        lambda i: (i == 0) | (F.get(tokens, i)["term"] != F.get(tokens, i - 1)["term"]),
    )
    marked = sized.withColumn("__starts", F.when(length > 0, first_of_run))
    runs = F.transform(
        starts,
        lambda start, run: F.struct(
            F.get(tokens, start)["term"].alias("term"),
            F.slice(
                tokens, start + 1, F.coalesce(F.get(starts, run + 1), length) - start
            )["position"].alias("positions"),
        ),
    )
    return marked.select("shard", "_id", "doc_len", F.explode(runs).alias("__run")).select(
        "shard",
        F.col("__run.term").alias("term"),
        "_id",
        F.size("__run.positions").alias("tf"),
        F.col("__run.positions").alias("positions"),
        "doc_len",
    )


def term_dictionary(post: DataFrame) -> DataFrame:
    """``(term, doc_freq, total_tf)``; counts are combined per map task before the shuffle."""
    return post.groupBy("term").agg(
        F.count(F.lit(1)).alias("doc_freq"), F.sum("tf").alias("total_tf")
    )


def field_stats(post: DataFrame) -> DataFrame:
    """One row ``(doc_count, sum_tokens, avg_len)`` over documents with at least one token.

    Each document has exactly one posting that holds its position 0, so documents are counted
    without a distinct.
    """
    first = F.get("positions", F.lit(0)) == 0
    return with_average(
        post.agg(
            F.count_if(first).alias("doc_count"),
            F.coalesce(F.sum("tf"), F.lit(0)).alias("sum_tokens"),
        )
    )


def with_average(stats: DataFrame) -> DataFrame:
    """``(doc_count, sum_tokens)`` with ``avg_len``."""
    return stats.withColumn(
        "avg_len",
        F.when(F.col("doc_count") > 0, F.col("sum_tokens") / F.col("doc_count")).otherwise(0.0),
    )
