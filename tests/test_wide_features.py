"""Feature tables of any width, and as many fits at a time as the driver holds."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import SparseVector, Vectors
from pyspark.sql import functions as F

from tallyloom.operators import classify, features, tuning


def test_assembled_vectors_are_those_of_the_assembler(spark):
    """Zeros that are stored, dense inputs, and rows that are shorter dense."""
    rng = np.random.default_rng(2)
    rows = []
    for k in range(40):
        a, b = (np.where(rng.random(n) < k / 40, rng.integers(-1, 3, n), 0).astype(float) for n in (6, 9))
        some = np.flatnonzero(rng.random(6) < 0.7)
        left = Vectors.sparse(6, some.tolist(), a[some].tolist())
        rows.append((k, float(k % 3 == 0), float(k % 2) or -0.0, left, Vectors.dense(b)))
    df = spark.createDataFrame(rows, ["k", "x", "y", "a", "b"])
    theirs = VectorAssembler(inputCols=["x", "y", "a", "b"], outputCol="features").transform(df)
    want = {r.k: r.features for r in theirs.collect()}
    made = features.assembled(df, ["k"], ["x", "y"], {"a": 6, "b": 9}, "t")
    got = {r.k: r.features for r in made.collect()}
    assert got == want and {type(v) for v in got.values()} == {type(v) for v in want.values()}
    assert any(isinstance(v, SparseVector) for v in got.values()) and not made.schema["features"].metadata
    for column in ("x", "a"):
        gone = df.withColumn(column, F.when(F.col("k") != 7, F.col(column)))
        with pytest.raises(Exception, match="a feature is missing"):
            features.assembled(gone, ["k"], ["x", "y"], {"a": 6, "b": 9}, "t")


@pytest.mark.parametrize("width", [2, 3, 5, 9, 20])
def test_vectors_are_dense_where_those_of_the_assembler_are(spark, width):
    """Numbers alone, and the same numbers with a vector, with any number of entries."""
    names = [f"c{i}" for i in range(width)]
    rows = [(k, *[float(i < k) for i in range(width)], Vectors.sparse(4, [0], [1.0])) for k in range(width + 1)]
    df = spark.createDataFrame(rows, ["k", *names, "v"])
    for vector in ({}, {"v": 4}):
        theirs = VectorAssembler(inputCols=[*names, *vector], outputCol="features").transform(df).collect()
        made = features.assembled(df, ["k"], names, vector, "t").collect()
        assert {r.k: (type(r.features), r.features) for r in made} == {r.k: (type(r.features), r.features) for r in theirs}


def test_feature_tables_are_made_without_an_assembler(spark, monkeypatch):
    """It names each slot on the driver."""
    monkeypatch.setattr(features, "assembler", None)
    rows = spark.range(60).select(
        F.col("id").alias("job_id"), (F.col("id") % 2).cast("double").alias("label"), F.lit(1.0).alias("telecommuting"),
        F.array(F.concat(F.lit("w"), F.col("id").cast("string"))).alias("title"),
    )
    ready = classify.build_features(rows, 30)
    assert ready.width == 31 and ready.train.count() and all(len(r.features) == 31 for r in ready.train.collect())


def test_no_more_fits_at_a_time_than_the_driver_holds(spark, monkeypatch):
    rows = spark.createDataFrame([(float(k % 2), Vectors.dense([k % 7, k % 3]), k % 4) for k in range(80)], ["label", "features", "f"]).coalesce(1)
    seen = []
    monkeypatch.setattr(tuning, "ThreadPoolExecutor", lambda n, make=tuning.ThreadPoolExecutor: seen.append(n) or make(n))
    monkeypatch.setattr(tuning, "_heap", lambda spark: 2 * 8 * tuning.HELD * 1000)
    for slots in (None, 300, 5000):
        tuning.cross_validate(LogisticRegression(maxIter=1), [{}], BinaryClassificationEvaluator(), rows, F.col("f"), 4, keyed=False, slots=slots)
    assert seen[0] >= tuning.PARALLEL_FITS[0] and seen[1:] == [3, 1]
