"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import shutil
import tempfile
from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@lru_cache(maxsize=None)
def _shipped(app: str) -> str:
    root = Path(__file__).resolve().parents[2]
    return shutil.make_archive(f"{tempfile.mkdtemp()}/tallyloom", "zip", root, "tallyloom")


# For rows that hold whole texts: JVM and worker each keep a batch or two in every task.
SMALL_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4194304",
}


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers, which may start in any folder."""
    spark.sparkContext.addPyFile(_shipped(spark.sparkContext.applicationId))


def small_batches(spark: SparkSession) -> None:
    """Ask for Arrow batches of ``SMALL_BATCHES``; a setting that the session was given stays.

    For the registered queries and the pipeline, which own their session's settings. The
    operators change none.
    """
    given = spark.conf.getAll
    for name, value in SMALL_BATCHES.items():
        if name not in given:
            spark.conf.set(name, value)


def _place(columns: list[str], name: str) -> int:
    folded = [c.lower() for c in columns]
    return columns.index(name) if name in columns else folded.index(name.lower())


def plain(df: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """``df`` with columns c0, c1, … and what the named ones are called there.

    So a column is found also where another has the same name in other case.
    """
    renamed = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return renamed, [f"c{_place(df.columns, n)}" for n in names]


def named(rows: DataFrame, df: DataFrame) -> DataFrame:
    """The columns c0, c1, … of ``rows`` under the names of ``df``."""
    return rows.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns)))


def take(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only."""
    renamed, places = plain(df, *names)
    return renamed.select(*(F.col(c).alias(n) for c, n in zip(places, names)))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text modulo ``folds``; a NULL id gives NULL."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(folds)


def workers(spark: SparkSession) -> int:
    """How many tasks an exchange of this session makes."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
