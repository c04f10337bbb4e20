"""Means and item-item cosine similarity of mean-centred ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tallyloom.operators import pairs


def rating_totals(ratings: DataFrame, key: str = "item_id") -> DataFrame:
    """Count and sum of the ratings per key."""
    return ratings.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_ratings"), F.sum("rating").alias("rating_sum")
    )


def item_means(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("item_id").agg(F.avg("rating").alias("item_mean"))


def user_means(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("user_id").agg(F.avg("rating").alias("user_mean"))


def centre(ratings: DataFrame, means: DataFrame) -> DataFrame:
    """Ratings with ``centred = rating - item_mean``. ``means`` should be a written table."""
    return ratings.join(means, "item_id").withColumn(
        "centred", F.col("rating") - F.col("item_mean")
    )


def user_residual_means(ratings: DataFrame, means: DataFrame) -> DataFrame:
    return (
        centre(ratings, means)
        .groupBy("user_id")
        .agg(F.avg("rating").alias("user_mean"), F.avg("centred").alias("residual_mean"))
    )


def item_similarities(
    ratings: DataFrame,
    means: DataFrame,
    load: pairs.UserLoad,
    min_support: int = 1,
) -> DataFrame:
    """``(item_i, item_j, similarity, support)`` with ``item_i < item_j``.

    The co-rated rows are neither stored nor shuffled: they come up cell by cell, and the sums of a
    pair are whole in its cell (``pairs.matches_by_cell``). Centred values travel with the ratings,
    which spares joining the much larger pair table with the means. ``load`` comes from
    ``pairs.user_load``.
    """
    sums = _sums(centre(ratings, means), load)
    if min_support > 1:
        sums = sums.filter(F.col("support") >= min_support)
    norm = F.sqrt("xx") * F.sqrt("yy")
    cosine = F.when(norm > 0, F.col("xy") / norm).otherwise(F.lit(0.0))
    return sums.select(
        F.least("a", "b").alias("item_i"),
        F.greatest("a", "b").alias("item_j"),
        F.round(cosine, 6).alias("similarity"),
        "support",
    )


def _sums(centred: DataFrame, load: pairs.UserLoad) -> DataFrame:
    """``(a, b, xy, xx, yy, support)`` of each pair."""
    if isinstance(centred.schema["item_id"].dataType, T.IntegralType):
        return pairs.sums_by_cell(centred, "item_id", "centred", load)
    both = pairs.matches_by_cell(centred, "item_id", "centred", load)
    x, y = F.col("a")["value"], F.col("b")["value"]
    return both.groupBy("cell", F.col("a")["id"].alias("a"), F.col("b")["id"].alias("b")).agg(
        F.sum(x * y).alias("xy"),
        F.sum(x * x).alias("xx"),
        F.sum(y * y).alias("yy"),
        F.count(F.lit(1)).alias("support"),
    )
