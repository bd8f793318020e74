"""Last write wins per document id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardloom.operators.documents import column

_ROW_NUMBER = "__version_rank"


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(_orderable(field.dataType) for field in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def upsert_by_id(
    df: DataFrame, order_by: Column | str | Sequence[Column | str], id_column: str = "_id"
) -> DataFrame:
    """The newest row of each id: the one that is last by ``order_by``.

    Ties are broken by the remaining columns, so a re-run keeps the same row.  Spark cuts each
    map task's rows to one per id before they are shuffled (the partial window group limit),
    so an id with any share of the rows sends at most one row per map task.
    """
    keys = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    if not keys:
        raise ValueError("order_by is needed to tell which row of an id is the newest")
    named = {key for key in keys if isinstance(key, str)} | {id_column}
    # Maps and variants have no order of their own: their JSON text has.
    ties = [
        column(field.name) if _orderable(field.dataType) else F.to_json(F.struct(column(field.name)))
        for field in df.schema.fields
        if field.name not in named
    ]
    order = [key if isinstance(key, Column) else F.col(key) for key in keys] + ties
    newest = Window.partitionBy(column(id_column)).orderBy(*[key.desc_nulls_last() for key in order])
    return (
        df.withColumn(_ROW_NUMBER, F.row_number().over(newest))
        .where(F.col(_ROW_NUMBER) == 1)
        .drop(_ROW_NUMBER)
    )
