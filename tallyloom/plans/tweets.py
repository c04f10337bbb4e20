"""Tweet workflow: language, sentiment, topics, and sentiment classifiers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from tallyloom import store
from tallyloom.functions import text
from tallyloom.operators import features, language, metrics, sampling, sentiment, topics, tuning

# Search points of the two sentiment models, and their folds.
TFIDF_GRID = {"maxIter": [10], "regParam": [0.2]}
TOPIC_GRID = {"maxIter": [20], "regParam": [0.2]}
FOLDS = 2


def identify(docs: DataFrame, key: str, words_from: str, label: str) -> DataFrame:
    """Profiles from the labelled texts, then the best language of every text."""
    profile = language.fit_profile(docs, words_from, label)
    return language.score_languages(docs, profile, key, words_from)


def english(docs: DataFrame, key: str, words_from: str, label: str) -> DataFrame:
    """Texts identified as English, with the identified language in ``label``."""
    found = identify(docs.dropna(subset=[words_from]), key, words_from, label)
    kept = language.keep_language(found.select(key, "lang"))
    return docs.drop(label).join(kept, key)


def tokenised(docs: DataFrame, key: str, words_from: str, *keep: str) -> DataFrame:
    """Cleaned content words, written once for the learners that iterate over them."""
    words = text.content_tokens(text.clean_tweet(F.col(words_from)))
    return store.materialise(docs.select(key, *keep, words.alias("words")), "words")


def labelled(docs: DataFrame, lexicon: DataFrame, key: str, words_from: str) -> DataFrame:
    """English texts with sentiment label and content words."""
    known = store.materialise(lexicon, "lexicon")
    kept = language.keep_language(docs)
    marked = sentiment.sentiment_score(kept, known, key, words_from)
    rows = kept.join(marked.select(key, F.col("sentiment").alias("label")), key)
    return tokenised(rows, key, words_from, "label")


@dataclass
class SentimentModel:
    scored: DataFrame
    area_under_roc: DataFrame


def train_sentiment(rows: DataFrame, key: str, with_topics: bool = False) -> SentimentModel:
    """Logistic regression on hashed TF-IDF, and on topic shares too with ``with_topics``.

    Both sides get the same preparation; features are fitted on train rows, classes are
    balanced on train rows only, and the curve uses scores and not hard predictions.
    """
    train, test = sampling.hash_split(rows, F.col(key), [70, 30])
    if with_topics:
        stages = topics.hashed_pipeline().getStages()
        inputs, points = ["tfidf", "topicDistribution"], TOPIC_GRID
    else:
        stages = features.hashed_tfidf("words", "tfidf", topics.HASHED_WIDTH)
        inputs, points = ["tfidf"], TFIDF_GRID
    shaped = topics.fit(Pipeline(stages=[*stages, features.assembler(inputs)]), train)
    balance = sampling.balancing_fractions(train, "label")
    chosen = F.concat(F.lit("sample:"), F.col(key).cast("string"))
    balanced = sampling.stratified_hash_sample(train, "label", balance, chosen)
    ready = store.materialise(
        shaped.transform(balanced).select(key, "label", features.bare()), "sentiment-train"
    )
    learner = LogisticRegression()
    model = tuning.cross_validate(
        learner,
        tuning.grid(learner, **points),
        BinaryClassificationEvaluator(),
        ready,
        F.concat(F.lit("fold:"), F.col(key).cast("string")),
        FOLDS,
    ).model
    scored = store.materialise(
        model.transform(shaped.transform(test).select(key, "label", features.bare())).select(
            key,
            "label",
            "prediction",
            vector_to_array("rawPrediction")[1].alias("score"),
        ),
        "sentiment-scored",
    )
    return SentimentModel(scored, metrics.auc(scored))
