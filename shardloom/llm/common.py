"""What several operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

Query = Callable[[SparkSession, str], DataFrame]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def word_list(text: Column) -> Column:
    """Words in order; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda word: word != "")


def lower_ascii(text: Column) -> Column:
    """A-Z to lower case, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's text modulo ``folds``; 0 for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds)), F.lit(0))


def shared_folder(spark: SparkSession) -> None:
    """Have a checkpoint folder: ``spark.checkpoint.dir``, or one of our own where it is unset."""
    if spark.sparkContext.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not spark.conf.get("spark.master", "local").startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a new folder below the shared one, and read again."""
    spark = df.sparkSession
    shared_folder(spark)
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def columns_of(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever they are named."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in df.columns]


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def release_memory() -> None:
    """Give what a task has freed back to the system: its worker process lives on, with other stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def text_bytes(df: DataFrame, text: str = "text") -> int:
    """Bytes of all texts: what sizes of groups are derived from."""
    return df.agg(F.sum(F.octet_length(text))).first()[0] or 0


#: Rows of narrow columns that are small enough to be sent to every executor; beyond, a shuffle.
BROADCAST_ROWS = 200_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` computed once; to be broadcast only if it is counted to be small."""
    kept = cut(df)
    return F.broadcast(kept) if kept.count() <= rows else kept


def shingle_hashes(words: Column, n: int) -> Column:
    """Distinct 64-bit hashes of ``n`` consecutive words; empty with fewer words."""
    starts = F.slice(words, F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(0)))
    return F.array_distinct(
        F.transform(starts, lambda word, i: F.xxhash64(word, *[F.get(words, i + k) for k in range(1, n)]))
    )


def shingles(words: Column, n: int) -> Column:
    """Distinct texts of ``n`` consecutive words, joined by a space; empty with fewer words."""
    starts = F.slice(words, F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(0)))
    return F.array_distinct(
        F.transform(
            starts, lambda word, i: F.concat_ws(" ", word, *[F.get(words, i + k) for k in range(1, n)])
        )
    )
