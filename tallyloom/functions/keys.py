"""Deterministic pseudo-random numbers from row keys.

``sampleBy`` and ``randomSplit`` draw by row position, so a recomputed partition can give
different rows. These forms depend on the key alone: same rows on any cluster, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom import store

TWO_POW_32 = 4294967296.0


def key_bits(key: Column) -> Column:
    """First 32 bits of the MD5 of the key's decimal text, as BIGINT."""
    head = F.substring(F.md5(key.cast("string").cast("binary")), 1, 8)
    return F.conv(head, 16, 10).cast("bigint")


def key_unit(key: Column) -> Column:
    """The same bits as a number in [0, 1)."""
    return key_bits(key) / F.lit(TWO_POW_32)


def rating_key(user: Column, item: Column) -> Column:
    """Text, as no number formed from two BIGINT ids is safe from overflow."""
    return F.concat_ws(":", user.cast("string"), item.cast("string"))


def fold_number(key: Column, folds: int) -> Column:
    """Fold id for ``CrossValidator(foldCol=...)``.

    The bits are divided first: a modulo on the bits used for the train/test split would
    leave some folds empty whenever the two moduli share a factor.
    """
    return F.pmod(F.floor(key_bits(key) / F.lit(100)), F.lit(folds)).cast("int")


def dense_ids(df: DataFrame, column: str, number: str) -> DataFrame:
    """``(column, number)``: the distinct values in order, numbered from 0, as a written table.

    The values are sorted by ranges; each range is numbered in its own task and starts from the
    counts of the ranges before it. An id beyond INT is an error, not a wrong number.
    """
    ids = df.select(column).dropna().distinct().repartitionByRange(column)
    placed = store.materialise(ids.withColumn("_part", F.spark_partition_id()), "ids")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_part").count()
    starts = starts.select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_part").orderBy(column)
    place = F.col("_start") + F.row_number().over(inside) - 1
    numbered = placed.join(starts, "_part").withColumn(number, place.cast("int"))
    return store.materialise(numbered.select(column, number), "dense-ids")
