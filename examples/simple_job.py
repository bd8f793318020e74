"""Snapshot a table of documents, the longest row of each id winning, and search its texts.

``spark-submit examples/simple_job.py <documents.parquet> <output folder> <words...>``
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import shardloom as sl

FIELDS = {
    "properties": {
        "text": {"type": "text"},
        "lang": {"type": "keyword"},
        "source": {"type": "keyword"},
        "n_chars": {"type": "integer"},
    }
}


def main(documents: str, output: str, words: str) -> None:
    spark = SparkSession.builder.appName("snapshot-and-search").getOrCreate()
    rows = spark.read.parquet(documents)
    written = sl.write_snapshot(
        rows, output, "corpus", FIELDS, num_shards=8, id_field="doc_id", order_by="n_chars"
    )
    snapshot = sl.open_snapshot(spark, written.path)
    snapshot.documents().groupBy("fields.lang").agg(F.count("*").alias("documents")).show()
    snapshot.write_search_tables("text")
    for hit in snapshot.match("text", words, 5).collect():
        print(f"{hit['_score']:.3f}  {hit['_id']}  {hit['_source'][:80]}")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2], " ".join(sys.argv[3:]))
