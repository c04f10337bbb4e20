"""The perceptron's fit in one task against MLlib's own."""

import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallyloom.operators import classify, perceptron

LAYERS = [12, 9, 5, 2]


def rows_of(spark, many, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(many):
        values = np.where(rng.random(12) < 0.4, rng.normal(size=12), 0.0)
        label = float(values[:4].sum() + 0.5 * rng.normal() > 0)
        some = np.flatnonzero(values)
        rows.append((k, label, Vectors.dense(values) if k % 5 == 0 else Vectors.sparse(12, some.tolist(), values[some].tolist())))
    return spark.createDataFrame(rows, ["id", "label", "features"]).coalesce(1)


@pytest.mark.parametrize("steps", [1, 5, 60])
def test_weights_are_those_of_mllib(spark, steps):
    """Stacks of 16 rows, the last of 4: a row of it counts four times as much."""
    table = rows_of(spark, 100)
    given = {"layers": LAYERS, "seed": 3, "blockSize": 16, "maxIter": steps}
    mine = perceptron.Perceptron(**given).fit(table)
    theirs = MultilayerPerceptronClassifier(**given).fit(table)
    assert type(mine) is type(theirs) and len(mine.weights) == len(theirs.weights)
    near = 1e-6 if steps < 60 else 0.05
    assert np.abs(mine.weights.toArray() - theirs.weights.toArray()).max() < near * np.abs(theirs.weights.toArray()).max()
    params = lambda m: {p.name: v for p, v in m.extractParamMap().items()}
    assert params(mine) == params(theirs)
    both = mine.transform(table).select("id", F.col("prediction").alias("a")).join(theirs.transform(table), "id")
    assert both.where("a <> prediction").count() <= (0 if steps < 60 else 1)


def test_one_job_fits_a_small_table(spark):
    """MLlib runs several jobs a step, and gets all weights back from each."""
    table = rows_of(spark, 60).cache()
    table.count()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("perceptron", "fit")
    try:
        learner = classify.learner("mlp", 12).copy({})
        learner.setLayers(LAYERS).setMaxIter(20)
        learner.fit(table)
        assert len(tracker.getJobIdsForGroup("perceptron")) <= 2
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        table.unpersist()


def test_other_tables_are_left_to_mllib(spark, monkeypatch):
    monkeypatch.setattr(perceptron, "minimise", None)
    many = rows_of(spark, 40).repartition(3)
    assert perceptron.Perceptron(layers=LAYERS, seed=0, maxIter=2).fit(many).weights
    wrong = rows_of(spark, 10).withColumn("label", F.col("label") + 2)
    monkeypatch.undo()
    with pytest.raises(Exception):
        perceptron.Perceptron(layers=LAYERS, seed=0, maxIter=2).fit(wrong)
