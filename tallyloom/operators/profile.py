"""Column profiles, class filters and data-driven column choice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _newline_count(df: DataFrame, name: str) -> Column:
    if not isinstance(df.schema[name].dataType, T.StringType):
        return F.lit(0).cast("bigint")
    return F.count_if(F.col(name).contains("\n"))


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: rows, NULLs and values holding a newline, all from one scan."""
    per_column = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(F.col(c).isNull()).alias("null_count"),
            _newline_count(df, c).alias("newline_count"),
        )
        for c in df.columns
    ]
    return df.agg(F.array(*per_column).alias("stats")).select(F.inline("stats"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def valid_classes(df: DataFrame, label: str, classes: Sequence[int] = (0, 1)) -> DataFrame:
    """Keep rows whose label is one of ``classes``; NULL labels go too."""
    return df.filter(F.col(label).isin(*classes))


def sparse_columns(df: DataFrame, max_null_share: float = 0.01) -> list[str]:
    """Names of columns whose NULL share is above the limit.

    Action: one aggregate, whose single row of counts comes to the driver.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(df.columns)],
    ).first()
    limit = counts["total"] * max_null_share
    return [c for i, c in enumerate(df.columns) if counts[f"nulls_{i}"] > limit]


def drop_sparse_columns(df: DataFrame, max_null_share: float = 0.01) -> DataFrame:
    return df.drop(*sparse_columns(df, max_null_share))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("row_count"))


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """Every column but the named ones, in order."""
    return [c for c in df.columns if c not in set(exclude)]
