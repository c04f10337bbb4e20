"""A training corpus from ``documents``: five stages, each written as Parquet and read again.

1. ``language``  a document goes if its text has no letter or no language was learned; mixed texts
                 and those of languages not learned stay (``language_mix.keep``)
2. ``exact``     of equal texts one stays, the one with the largest id
3. ``near``      of texts with fingerprints at most 3 bits apart, directly or over others, one
                 stays, the one with the smallest id
4. ``private``   personal data in the texts is masked; no document goes
5. ``packed``    the texts' ids, packed into sequences: one row per piece of a document

The first four return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom import store
from tallyloom.llm import exact_dedup, language_mix, packing, pii, simhash
from tallyloom.llm.common import fold, ship, small_batches, table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END = 0


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    small_batches(spark)
    return language_mix.keep(docs, language_mix.fit(docs, fold(F.col("doc_id"), 4) != 2))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    small_batches(spark)
    return simhash.keep(docs, words=3, radius=3)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    small_batches(spark)
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian), sequence_id, offset."""
    ship(spark)
    small_batches(spark)
    return packing.pack(packing.pieces(docs, VOCABULARY, END))


STAGES = [
    ("language", language),
    ("exact", exact),
    ("near", near),
    ("private", private),
    ("packed", packed),
]

# Language shares, bit distances and token ids have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store.materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
