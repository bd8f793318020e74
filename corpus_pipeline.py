"""From documents to a training mix: five stages, each an operator of ``shardloom.llm``.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which ``run`` writes as Parquet to
the shared folder and reads again as the next one's docs.  All but the last return the columns of
documents.

1. language_id: documents without a language, or with an unsure one, go.
2. near_dedup: of documents that share 80% of their shingles of five words, directly or through
   others, the one with the smallest id stays.
3. suffix_dedup: strings of 50 bytes that also start in a document with a smaller id are cut out of
   the texts; documents of which nothing is left go.
4. decontamination: documents that hold a test item go.
5. mixing: the copies and words that the mix takes of each document.

Rows are judged one by one, not by id: other texts of an id stay, and of equal rows of one id and text one
stays.  Rows without an id are judged like others and come last in their group, rows without a text go
in stage 1; ties go to the smallest id; very long texts are worked on whole; other columns stay as they are; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shardloom.llm.common import read, stored
from shardloom.llm.decontaminate import without_items
from shardloom.llm.langid import keep_identified
from shardloom.llm.mixing import mix
from shardloom.llm.near_duplicates import one_of_each
from shardloom.llm.suffixes import without_repeats


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_items(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: Language models, MinHash components and rounding draws are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
