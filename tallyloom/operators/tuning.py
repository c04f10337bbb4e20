"""Parameter grids and cross-validation with folds fixed by key."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.util import inheritable_thread_target

from tallyloom.functions import keys

# How many fits run at a time, at least and at most, unless told otherwise.
PARALLEL_FITS = (4, 16)
#: Numbers a weight that a fit holds on the driver: ten corrections of two, and what its steps need.
HELD = 40


def grid(estimator: Estimator, **values: Sequence) -> list[dict]:
    """Every combination of the values given per parameter name."""
    builder = ParamGridBuilder()
    for name, options in values.items():
        builder = builder.addGrid(getattr(estimator, name), list(options))
    return builder.build()


@dataclass
class Tuned:
    """The model refitted on all rows, and the mean fold metric of each grid point."""

    model: Model
    points: list[dict]
    fold_metrics: list[float]

    def search(self, spark: SparkSession) -> DataFrame:
        """``(point, params, metric)``: one row per grid point that was cross-validated."""
        rows = [
            (i, ", ".join(sorted(f"{p.name}={v}" for p, v in point.items())), float(m))
            for i, (point, m) in enumerate(zip(self.points, self.fold_metrics))
        ]
        return spark.createDataFrame(rows, "point int, params string, metric double")


def _heap(spark: SparkSession) -> int:
    """Bytes that the driver's heap may grow to."""
    return spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory()


def cross_validate(
    estimator: Estimator,
    points: list[dict],
    evaluator: Evaluator,
    train: DataFrame,
    key: Column,
    folds: int,
    parallel: int | None = None,
    keyed: bool = True,
    slots: int | None = None,
) -> Tuned:
    """Fit every grid point on every fold, then the best point on all of ``train``.

    ``key`` is what decides a row's fold, or, unless ``keyed``, the fold itself.

    Pass a ``train`` that is a written or persisted table: each fold reads it twice. As many fits
    run at a time as fill the cores with the tasks of ``train``, whatever their folds and points:
    ``CrossValidator`` runs the points of one fold side by side, and one fold after the other.

    ``slots`` is the number of weights of a learner whose fits hold theirs on the driver: no more fits run
    at a time than half its heap holds.
    """
    spark = train.sparkSession
    if parallel is None:
        least, most = PARALLEL_FITS
        parallel = min(most, max(least, spark.sparkContext.defaultParallelism // max(1, train.rdd.getNumPartitions())))
        if slots:
            parallel = max(1, min(parallel, _heap(spark) // (2 * 8 * HELD * slots)))
    fold = keys.fold_number(key, folds) if keyed else key
    wrong = F.raise_error(F.concat(F.lit(f"fold number must be in [0, {folds}): "), F.coalesce(fold.cast("string"), F.lit("NULL"))))
    rows = train.withColumn("fold", F.when(fold.between(0, folds - 1), fold).otherwise(wrong.cast("int")))
    parts = [(rows.filter(F.col("fold") != i).cache(), rows.filter(F.col("fold") == i).cache()) for i in range(folds)]

    def fold_metric(fold: int, point: dict) -> float:
        fitted, held_out = parts[fold]
        for name, part in (("training", fitted), ("validation", held_out)):
            if part.isEmpty():
                raise ValueError(f"The {name} data at fold {fold} is empty.")
        return evaluator.evaluate(estimator.fit(fitted, point).transform(held_out, point))

    pool = ThreadPoolExecutor(parallel)
    try:

        def start(fn, *given):
            return pool.submit(inheritable_thread_target(spark)(fn), *given)

        # A single point needs no fold to be chosen, so its fit on all rows is not left to the end.
        whole = start(estimator.fit, rows, points[0]) if len(points) == 1 else None
        running = [[start(fold_metric, i, point) for i in range(folds)] for point in points]
        means = [float(np.mean([f.result() for f in of_point])) for of_point in running]
        best = np.argmax(means) if evaluator.isLargerBetter() else np.argmin(means)
        model = whole.result() if whole else estimator.fit(rows, points[best])
    finally:
        pool.shutdown(cancel_futures=True)
        for fitted, held_out in parts:
            fitted.unpersist()
            held_out.unpersist()
    return Tuned(model, points, means)
