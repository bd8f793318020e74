"""JSON-lines files as documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.config import DEFAULT_ID_FIELD
from shardloom.operators.documents import checked_object, member_text, require_id, without_member

# What counts as blank at either end of a line, U+0000 to U+0020.
BLANKS = "".join(map(chr, range(0x21)))


def skip_blank_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Trim control characters and spaces at both ends; drop lines with nothing left."""
    trimmed = lines.withColumn(value, F.trim(F.col(value), F.lit(BLANKS)))
    return trimmed.where(F.col(value) != "")


def read_jsonl_documents(
    spark: SparkSession,
    path: str | list[str],
    id_field: str = DEFAULT_ID_FIELD,
    keep_id: bool | None = None,
) -> DataFrame:
    """``(_id, source)`` from files with one JSON object per line.

    Any JSON value serves as id, by its text.  By default the id leaves the source only if its field
    is ``_id``; all else in the source stays as it is written.  Malformed JSON, a repeated key, a line
    that is not an object and a missing or null id fail the job.
    """
    if keep_id is None:
        keep_id = id_field != DEFAULT_ID_FIELD
    lines = skip_blank_lines(spark.read.text(path).select("value", "_metadata.file_path"))
    where = F.concat(F.lit("line in "), F.col("file_path"))
    line = F.col("line")
    return lines.select("file_path", checked_object(F.col("value"), where).alias("line")).select(
        require_id(member_text(line, id_field), id_field, F.col("file_path")).alias("_id"),
        (line if keep_id else without_member(line, id_field)).alias("source"),
    )
