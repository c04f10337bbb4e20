"""Samples and splits: Spark's own draws, and repeatable ones by key hash."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions import keys


def native_sample_by(
    df: DataFrame, label: str, fractions: dict, seed: int = 0
) -> DataFrame:
    """``sampleBy`` with the keys brought to the column's type.

    A key of another type matches nothing and would give an empty sample.
    """
    kind = df.schema[label].dataType.simpleString()
    convert = str if kind == "string" else (int if kind in ("int", "bigint") else float)
    return df.sampleBy(label, {convert(k): v for k, v in fractions.items()}, seed=seed)


def native_random_split(
    df: DataFrame, weights: Sequence[float], seed: int = 0
) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed=seed)


def _case(choices: Sequence[tuple[Column, Column]], default: Column) -> Column:
    return reduce(lambda rest, pick: F.when(*pick).otherwise(rest), reversed(choices), default)


def stratified_hash_sample(
    df: DataFrame, label: str, fractions: dict, key: Column
) -> DataFrame:
    """Keep a row when its key hash is below the fraction of its class; no shuffle."""
    fraction = _case(
        [(F.col(label) == F.lit(k), F.lit(float(v))) for k, v in fractions.items()],
        F.lit(0.0),
    )
    return df.filter(keys.key_unit(key) < fraction)


def split_number(key: Column, percents: Sequence[int]) -> Column:
    """Part of a row by key hash, from whole percentages that add up to 100."""
    if sum(percents) != 100:
        raise ValueError("percents must add up to 100")
    hundredth = keys.key_bits(key) % F.lit(100)
    bounds = [sum(percents[: i + 1]) for i in range(len(percents) - 1)]
    return _case(
        [(hundredth < F.lit(b), F.lit(i)) for i, b in enumerate(bounds)],
        F.lit(len(percents) - 1),
    )


def hash_split(df: DataFrame, key: Column, percents: Sequence[int]) -> list[DataFrame]:
    part = split_number(key, percents)
    return [df.filter(part == F.lit(i)) for i in range(len(percents))]


def balancing_fractions(df: DataFrame, label: str) -> dict:
    """Fractions that bring every class down to the size of the smallest.

    Action: one group count; the classes are few by definition of a label.
    """
    counts = {r[0]: r[1] for r in df.groupBy(label).count().dropna().collect()}
    least = min(counts.values(), default=0)
    return {k: least / n for k, n in counts.items()}
