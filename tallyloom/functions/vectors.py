"""ML vectors as ordinary columns, without filling in the zeros."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def vector_entries(vector: Column) -> Column:
    """Array of ``(index, value)`` for the stored entries of a sparse or dense vector."""
    parts = F.unwrap_udt(vector)
    places = F.coalesce(
        parts["indices"], F.sequence(F.lit(0), F.size(parts["values"]) - F.lit(1))
    )
    return F.arrays_zip(places.alias("index"), parts["values"].alias("value"))


def vector_rows(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``(key, index, value)``, one row per stored entry."""
    return df.select(key, F.explode(vector_entries(F.col(vector))).alias("e")).select(
        key, F.col("e")["index"].alias("index"), F.col("e")["value"].alias("value")
    )
