"""Language identification by word profiles.

With ``c`` the count of a word in a language and ``n`` the language's word total, a word
scores ``ln((c + 1) / (n + 1000))`` and an unknown one ``ln(1 / (n + 1000))``. The difference
is ``ln(c + 1)``, so a text's score is ``sum(ln(c + 1)) - words * ln(n + 1000)``: one lookup
per word gives all languages at once, and no text is multiplied by the language list.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tallyloom import store
from tallyloom.functions import text

# Fixed value: smoothing mass added to every language total.
UNSEEN_MASS = 1000
MAX_LANGUAGES = 500
# Scores are rounded before they are ranked, so that summing order cannot change a winner.
SCORE_DIGITS = 4
UNKNOWN = "none"


@dataclass(frozen=True)
class LanguageProfile:
    """``weights(term, w: array)`` with one slot per language, and the language totals."""

    weights: DataFrame
    totals: dict[str, int]


def fit_profile(df: DataFrame, words_from: str, label: str) -> LanguageProfile:
    """Learn from the rows that have a label. Action: writes the word table and reads one
    total per language."""
    rows = df.where(F.col(label).isNotNull()).select(label, F.explode(text.western_words(F.col(words_from))).alias("term"))
    counted = store.materialise(
        rows.filter(F.col("term") != "").groupBy(label, "term").agg(F.count(F.lit(1)).alias("c")),
        "language-words",
    )
    sums = counted.groupBy(label).agg(F.sum("c").alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(sums) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in column {label}")
    totals = {r[label]: r["n"] for r in sorted(sums, key=lambda r: r[label])}
    slots = [
        F.coalesce(F.sum(F.when(F.col(label) == lang, F.log(F.col("c") + F.lit(1.0)))), F.lit(0.0))
        for lang in totals
    ]
    weights = counted.groupBy("term").agg(F.array(*slots).alias("w"))
    return LanguageProfile(store.materialise(weights, "language-profile"), totals)


def score_languages(
    df: DataFrame, profile: LanguageProfile, key: str, words_from: str
) -> DataFrame:
    """``(key, lang, score)`` with the best language; ties go to the first name.

    The word table is read from files, so the planner broadcasts it when it is small. A
    document's words sit in one task and are summed there before the shuffle by key.
    """
    languages = list(profile.totals)
    rows = df.select(key, F.explode(text.western_words(F.col(words_from))).alias("term"))
    hits = rows.join(profile.weights, "term", "left")
    sums = hits.groupBy(key).agg(
        F.count_if(F.col("term") != "").alias("n_words"),
        *[F.sum(F.col("w")[i]).alias(f"s{i}") for i in range(len(languages))],
    )
    options = [
        F.struct(
            (
                -F.round(
                    F.coalesce(F.col(f"s{i}"), F.lit(0.0))
                    - F.col("n_words") * F.log(F.lit(float(profile.totals[lang] + UNSEEN_MASS))),
                    SCORE_DIGITS,
                )
            ).alias("cost"),
            F.lit(lang).alias("lang"),
        )
        for i, lang in enumerate(languages)
    ]
    best = F.array_min(F.array(*options))
    known = F.col("n_words") > 0
    return sums.select(
        key,
        F.when(known, best["lang"]).otherwise(F.lit(UNKNOWN)).alias("lang"),
        F.when(known, -best["cost"]).otherwise(F.lit(0.0)).alias("score"),
    )


def keep_language(df: DataFrame, language: str = "en", column: str = "lang") -> DataFrame:
    return df.filter(F.col(column) == language)
