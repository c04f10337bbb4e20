"""Exact dedup in three combining steps, each of which compares the texts themselves.

1. *Local*: every task combines equal texts of its own rows before anything is shuffled
   (the partial side of the first aggregation), so a text that fills a third of the table
   leaves each task once.
2. *Salted*: the local winners meet in groups of digest and salt. The salt is the number of
   the task that made the winner, so the winners of one hot digest are spread over ``salts``
   tasks.
3. *Global*: the salt winners of a digest, at most ``salts`` of each text, are combined.

The text is a grouping key at every step, beside the digest: two texts that share a digest
are never merged. The digest only places the rows.

Documents then find their group by digest. Where two groups share one, which is looked up
first, they are told apart by their text. Both sides of that join are plain shuffles, the
groups being read from a written table, so Spark can split a hot digest.

NULL text counts as empty. NULL ids are below every other id: a group with NULL ids alone has
a NULL ``keep_id``. Rows that repeat both id and text are one document given twice: each such
row carries the group's values, and ``kept`` holds for all of them or for none. An empty table
gives an empty result. Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom import store
from tallyloom.llm import common

SALTS = 16


def normalise(text: Column) -> Column:
    return common.ascii_lower(F.coalesce(text, F.lit("")))


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def groups(
    docs: DataFrame,
    normalise: Callable[[Column], Column] = normalise,
    digest: Callable[[Column], Column] = sha256,
    salts: int = SALTS,
) -> DataFrame:
    """One row per distinct normalised text: digest, body, keep_id, group_size."""
    rows = _rows(docs, normalise, digest)
    salted = (
        rows.withColumn("salt", F.spark_partition_id() % F.lit(salts))
        .groupBy("digest", "salt", "body")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    return salted.groupBy("digest", "body").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )


def _rows(docs: DataFrame, normalise, digest) -> DataFrame:
    rows = common.take(docs, "doc_id", "text")
    return rows.select("doc_id", normalise(F.col("text")).alias("body")).select(
        "doc_id", digest(F.col("body")).alias("digest"), "body"
    )


def dedup(
    docs: DataFrame,
    normalise: Callable[[Column], Column] = normalise,
    digest: Callable[[Column], Column] = sha256,
    salts: int = SALTS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, digest, keep_id, group_size, kept.

    ``keep_id`` is the largest id of the rows with an equal text.
    """
    found = groups(docs, normalise, digest, salts)
    rows = _rows(docs, normalise, digest)
    keys = ["digest"]
    made = store.materialise(found.drop("body"), "exact-groups")
    if not made.groupBy("digest").count().where("count > 1").isEmpty():
        made, keys = store.materialise(found, "exact-groups-with-text"), ["digest", "body"]
    joined = rows.join(made, keys)
    return joined.select(
        "doc_id",
        "digest",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
    )


def keep(
    docs: DataFrame,
    normalise: Callable[[Column], Column] = normalise,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: one of each group, also of repeated rows."""
    found = store.materialise(groups(docs, normalise, digest).select("digest", "keep_id"), "exact-kept")
    rows, (doc_id, text) = common.plain(docs, "doc_id", "text")
    rows = rows.withColumn("digest", digest(normalise(F.col(text))))
    same = (rows["digest"] == found["digest"]) & rows[doc_id].eqNullSafe(found["keep_id"])
    repeats = Window.partitionBy(doc_id, "digest").orderBy(F.lit(0))
    kept = rows.join(found, same, "left_semi").withColumn("copy", F.row_number().over(repeats))
    return common.named(kept.where("copy = 1"), docs)
