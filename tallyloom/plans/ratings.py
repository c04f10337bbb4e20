"""Recommendation workflow: neighbours, factorisation, regression and their blends."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from tallyloom import store
from tallyloom.functions import keys
from tallyloom.operators import (
    blend,
    content,
    factorise,
    metrics,
    neighbours,
    pairs,
    sampling,
    similarity,
)

# Share of rows used for training and for testing.
SPLIT = [80, 20]


@dataclass
class SplitRatings:
    """Written rating rows with their part.

    Train-side means and the load per user are made, each with its own action, when they are
    first asked for: factorisation and regression need none of them.
    """

    rows: DataFrame
    block: int

    @cached_property
    def train(self) -> DataFrame:
        return self.rows.filter(F.col("part") == 0).drop("part")

    @cached_property
    def test(self) -> DataFrame:
        return self.rows.filter(F.col("part") == 1).drop("part")

    @cached_property
    def items(self) -> DataFrame:
        return store.materialise(similarity.item_means(self.train), "item-means")

    @cached_property
    def users(self) -> DataFrame:
        return store.materialise(similarity.user_means(self.train), "user-means")

    @cached_property
    def load(self) -> pairs.UserLoad:
        return pairs.user_load(self.rows, self.block)


def split_ratings(ratings: DataFrame, block: int = pairs.BLOCK_SIZE) -> SplitRatings:
    """Action: writes the ratings. The means come from train rows only."""
    key = keys.rating_key(F.col("user_id"), F.col("item_id"))
    rows = store.materialise(
        ratings.withColumn("part", sampling.split_number(key, SPLIT)), "ratings"
    )
    return SplitRatings(rows, block)


def baseline_predictions(data: SplitRatings) -> DataFrame:
    return neighbours.with_baseline(data.test, data.items, data.users).select(
        "user_id", "item_id", "rating", F.round("baseline", 6).alias("prediction")
    )


def item_mean_predictions(data: SplitRatings) -> DataFrame:
    middle = neighbours.global_item_mean(data.items).scalar()
    mean = F.coalesce(F.col("item_mean"), middle)
    return data.test.join(data.items, "item_id", "left").select(
        "user_id", "item_id", "rating", F.round(mean, 6).alias("prediction")
    )


def nearest(
    data: SplitRatings, k: int = neighbours.NEIGHBOURS, min_support: int = 1
) -> DataFrame:
    similar = store.materialise(
        similarity.item_similarities(data.train, data.items, data.load, min_support),
        "similarities",
    )
    rated = neighbours.with_baseline(data.train, data.items, data.users).withColumn(
        "residual", F.col("rating") - F.col("baseline")
    )
    return neighbours.top_neighbours(data.test, rated, similar, data.load, k)


def neighbour_predictions(
    data: SplitRatings, k: int = neighbours.NEIGHBOURS, min_support: int = 1
) -> DataFrame:
    test = neighbours.with_baseline(data.test, data.items, data.users)
    return neighbours.predict(test, nearest(data, k, min_support))


@dataclass
class Hybrid:
    factorised: DataFrame
    regressed: DataFrame
    neighbour: DataFrame
    two: DataFrame
    three: DataFrame

    def scores(self) -> DataFrame:
        """``(model, metric, value)`` of all five."""
        out = None
        for name in ("factorised", "regressed", "neighbour", "two", "three"):
            rows = metrics.regression_metrics(getattr(self, name))
            rows = rows.select(F.lit(name).alias("model"), "metric", "value")
            out = rows if out is None else out.unionByName(rows)
        return out


def hybrid(
    ratings: DataFrame,
    items: DataFrame,
    als_grid: dict | None = None,
    regression_grid: dict | None = None,
    folds: int = factorise.FOLDS,
) -> Hybrid:
    """Fit the three models on the same train rows and blend them over the same test rows.

    The grids default to the full ones. Each prediction table is written once.
    """
    data = split_ratings(ratings)
    factors = factorise.fit(data.train, als_grid, folds)
    regressed = store.materialise(
        content.fit_predict(data.train, data.test, items, regression_grid, folds), "regressed"
    )
    return blended(data, factorise.predict(factors, data.test), regressed)


def blended(data: SplitRatings, factorised: DataFrame, regressed: DataFrame) -> Hybrid:
    """The neighbour predictions and both blends for two given tables of predictions."""
    factorised = store.materialise(factorised, "factorised")
    neighbour = store.materialise(neighbour_predictions(data), "neighbour")
    two = blend.blend(factorised, regressed)
    return Hybrid(
        factorised, regressed, neighbour, two, blend.blend(two, neighbour, blend.THIRD_WEIGHTS)
    )
