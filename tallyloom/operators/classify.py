"""Posting classifiers: four learners over one prepared table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom import store
from tallyloom.functions import text
from tallyloom.operators import features, metrics, missing, perceptron, profile, sampling, tuning

FLAGS = ["telecommuting", "has_company_logo", "has_questions"]
WORDS = ["title", "description"]

# Hashed width for the perceptron and its hidden and output layers.
HASH_WIDTH = 1000
HIDDEN_LAYERS = [1000, 100, 2]

# One grid point per learner.
GRIDS = {
    "mlp": {"maxIter": [50]},
    "logistic": {"maxIter": [10], "regParam": [0.2]},
    "svc": {"maxIter": [50], "regParam": [0.4]},
    "forest": {"numTrees": [80], "maxDepth": [8]},
}
FOLDS = 10
#: Learners with a weight for each slot, which their fits hold many times over on the driver.
LINEAR = ["logistic", "svc"]
#: Stored bytes of feature vectors to a task of a fit.
TASK_BYTES = 32_000_000


def learner(name: str, width: int):
    if name == "mlp":
        return perceptron.Perceptron(seed=0, layers=[width, *HIDDEN_LAYERS])
    if name == "logistic":
        return LogisticRegression()
    if name == "svc":
        return LinearSVC()
    return RandomForestClassifier(seed=0)


def prepare(postings: DataFrame) -> DataFrame:
    """Valid classes, enough values per column, cleaned and tokenised. Action: the NULL counts."""
    label = F.col("fraudulent").try_cast("int")
    valid = profile.valid_classes(postings.withColumn("fraudulent", label), "fraudulent")
    kept = profile.drop_sparse_columns(valid)
    needed = [c for c in ["job_id", *WORDS, *FLAGS, "fraudulent"] if c in kept.columns]
    flags = [c for c in FLAGS if c in needed]
    words = [c for c in WORDS if c in needed]
    return missing.clean_flags(kept.select(*needed), flags).select(
        "job_id",
        F.col("fraudulent").cast("double").alias("label"),
        *[F.col(c).cast("double").alias(c) for c in flags],
        *[text.content_tokens(text.clean_prose(F.col(c))).alias(c) for c in words],
    )


def split(prepared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """70/30 by a hash of the key, salted so that it is independent of the sample's hash."""
    train, test = sampling.hash_split(prepared, split_key(), [70, 30])
    return train, test


def balanced(train: DataFrame, fractions: dict | None = None) -> DataFrame:
    """Train rows sampled by class; every test row is scored, so those are never sampled.

    ``fractions`` per class come from the class counts when not given, which is an action.
    """
    if fractions is None:
        fractions = sampling.balancing_fractions(train, "label")
    return sampling.stratified_hash_sample(train, "label", fractions, F.col("job_id"))


def split_key() -> Column:
    return F.concat(F.lit("split:"), F.col("job_id").cast("string"))


def feature_stages(prepared: DataFrame, widths: dict[str, int]) -> list:
    flags = [c for c in FLAGS if c in prepared.columns]
    stages = [features.imputer(flags)] if flags else []
    for name, width in widths.items():
        stages += features.hashed_tfidf(name, f"{name}_tfidf", width)
    return stages


@dataclass
class Prepared:
    """Assembled train and test tables and the width of their feature vectors."""

    train: DataFrame
    test: DataFrame
    width: int


def build_features(
    prepared: DataFrame, hash_width: int | None, fractions: dict | None = None
) -> Prepared:
    """Balance the train side and fit the feature stages on it alone. ``hash_width=None`` uses the
    vocabulary sizes. Actions: the fits, and both feature tables are written. The train table has
    as many partitions as its size asks for."""
    words = [c for c in WORDS if c in prepared.columns]
    train, test = split(prepared)
    train = balanced(train, fractions)
    widths = {
        w: hash_width if hash_width is not None else features.vocabulary_width(train, w)
        for w in words
    }
    model = Pipeline(stages=feature_stages(prepared, widths)).fit(train)
    flags = [c for c in FLAGS if c in prepared.columns]
    found = {f"{w}_tfidf": width for w, width in widths.items()}

    def written(rows: DataFrame, name: str) -> DataFrame:
        return features.assembled(model.transform(rows), ["job_id", "label"], flags, found, name)

    return Prepared(
        store.by_size(written(train, "train-features"), TASK_BYTES),
        written(test, "test-features"),
        len(flags) + sum(widths.values()),
    )


@dataclass
class Trained:
    name: str
    tuned: tuning.Tuned
    scored: DataFrame


def search(
    name: str, data: Prepared, folds: int = FOLDS, **grid
) -> tuning.Tuned:
    """Choose and fit one learner; keyword lists replace its usual grid."""
    estimator = learner(name, data.width)
    return tuning.cross_validate(
        estimator,
        tuning.grid(estimator, **(grid or GRIDS[name])),
        MulticlassClassificationEvaluator(),
        data.train,
        F.concat(F.lit("fold:"), F.col("job_id").cast("string")),
        folds,
        slots=data.width if name in LINEAR else None,
    )


def train_and_score(name: str, data: Prepared, folds: int = FOLDS, **grid) -> Trained:
    """Tune one learner and score the test rows once: the scores are a written table."""
    tuned = search(name, data, folds, **grid)
    scored = tuned.model.transform(data.test).select("job_id", "label", "prediction")
    return Trained(name, tuned, store.materialise(scored, f"scored-{name}"))


def hash_width(name: str) -> int | None:
    return HASH_WIDTH if name == "mlp" else None


def report(results: list[Trained]) -> DataFrame:
    """``(model, kind, name, value)``: parameters of the best model and its test metrics."""
    tables = []
    for r in results:
        spark = r.scored.sparkSession
        params = [
            (r.name, "param", p.name, str(v))
            for p, v in sorted(r.tuned.model.extractParamMap().items(), key=lambda kv: kv[0].name)
        ]
        tables.append(
            spark.createDataFrame(params, "model string, kind string, name string, value string")
        )
        scores = metrics.confusion_metrics(r.scored)
        tables.append(
            scores.select(
                F.lit(r.name).alias("model"),
                F.lit("metric").alias("kind"),
                F.col("metric").alias("name"),
                F.col("value").cast("string").alias("value"),
            )
        )
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out
