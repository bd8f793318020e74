"""Rows of any DataFrame as documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.operators.documents import column, extract_id, require_id, to_source_json


def source_struct(names: list[str]) -> Column:
    return F.struct(*[column(name).alias(name) for name in names])


def documents_from_dataframe(
    df: DataFrame, id_field: str = "_id", keep_id: bool = False
) -> DataFrame:
    """``(_id, source)`` with all other columns in the source.

    The id column leaves the source unless ``keep_id`` is set.
    """
    if id_field not in df.columns:
        raise ValueError(f"id field {id_field} is not a column of the input")
    names = [name for name in df.columns if keep_id or name != id_field]
    source = to_source_json(source_struct(names)) if names else F.lit("{}")
    return df.select(
        require_id(extract_id(id_field), id_field).alias("_id"), source.alias("source")
    )
