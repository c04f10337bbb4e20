"""Term tables in long form: one row per (document, term).

Rows are combined per document before they are shuffled by term, so a term found in every
document brings one row per document and not one per occurrence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom import store
from tallyloom.functions.text import STOP_WORDS


def explode_terms(
    df: DataFrame, key: str, words: Column, keep_stop_words: bool = False
) -> DataFrame:
    """One row per token. Filtering after the explode stays in generated code."""
    rows = df.select(key, F.explode(words).alias("term"))
    if not keep_stop_words:
        rows = rows.filter(~F.col("term").isin(STOP_WORDS))
    return rows.filter(F.col("term") != "")


def term_frequencies(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def term_counts(frequencies: DataFrame) -> DataFrame:
    """Occurrences and documents per term."""
    return frequencies.groupBy("term").agg(
        F.sum("tf").alias("occurrences"), F.count(F.lit(1)).alias("df")
    )


def vocabulary_size(rows: DataFrame) -> DataFrame:
    return rows.agg(F.countDistinct("term").alias("vocabulary_size"))


def document_frequencies(frequencies: DataFrame) -> DataFrame:
    return frequencies.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def tfidf_long(frequencies: DataFrame, documents: DataFrame) -> DataFrame:
    """``tf * ln((m + 1) / (df + 1))`` with ``m`` the number of rows of ``documents``.

    Pass ``frequencies`` as a written table: it is read twice, and its tokenising is the
    costly part. Action: writes the document frequencies.
    """
    spread = store.materialise(document_frequencies(frequencies), "document-frequencies")
    total = documents.agg(F.count(F.lit(1)).cast("double")).scalar()
    idf = F.log((total + F.lit(1.0)) / (F.col("df") + F.lit(1.0)))
    return frequencies.join(spread, "term").withColumn("tfidf", F.col("tf") * idf)
