"""One row per key, the same row on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _sortable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _sortable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_sortable(f.dataType) for f in data_type.fields)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def recency_names(df: DataFrame, key: Sequence[str], newest_first: Sequence[str]) -> list[str]:
    """Columns that decide which row of a key is newest: the given ones, then every other
    sortable column, so that ties have one answer."""
    present = [c for c in newest_first if c in df.columns and c not in key]
    return present + [
        f.name
        for f in df.schema.fields
        if f.name not in key and f.name not in present and _sortable(f.dataType)
    ]


def recency_order(df: DataFrame, key: Sequence[str], newest_first: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in recency_names(df, key, newest_first)]


def latest_per_key(
    df: DataFrame, key: Sequence[str], newest_first: Sequence[str] = ()
) -> DataFrame:
    """Newest row of each key; null key parts compare equal.

    ``row_number() = 1`` plans as a group limit on both sides of the shuffle: each
    map task already cuts a key to one row, so a key that holds a third of the
    table sends one row per task and never meets in one place.
    """
    order = recency_order(df, key, newest_first)
    if not order:
        return df.distinct()
    ranked = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")
