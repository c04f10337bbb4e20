"""Lexicon sentiment: the mean polarity of a text's known words, made binary."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyloom.functions import text


def sentiment_score(df: DataFrame, lexicon: DataFrame, key: str, words_from: str) -> DataFrame:
    """``(key, polarity, sentiment)``: 1 for positive, 0 for neutral, negative or no words.

    ``lexicon(term, polarity)`` should be a written table, so that its size is known.
    """
    rows = df.select(key, F.explode(text.english_words(F.col(words_from))).alias("term"))
    scored = rows.join(lexicon.select("term", "polarity"), "term", "left")
    mean = F.coalesce(F.avg("polarity"), F.lit(0.0))
    return (
        scored.groupBy(key)
        .agg(F.round(mean, 6).alias("polarity"))
        .withColumn("sentiment", F.when(F.col("polarity") > 0, 1).otherwise(0))
    )
