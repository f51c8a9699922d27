"""Weighting what local users say by their predicted expertise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.operators.scale import broadcast_if_small


def pair_ratings(review: DataFrame, businesses: DataFrame) -> DataFrame:
    """Sum and count of stars per user and business, of the given businesses only.

    The businesses are few next to the reviews: where their count allows, the review scan is
    filtered in place and only its matching rows are ever shuffled.
    """
    wanted = broadcast_if_small(businesses.select("business_id"))
    return (
        review.select("user_id", "business_id", "stars")
        .join(wanted, "business_id", "left_semi")
        .groupBy("user_id", "business_id")
        .agg(F.sum("stars").alias("stars_sum"), F.count("stars").alias("stars_count"))
    )


def local_user_business(
    review: DataFrame, local_businesses: DataFrame, local_users: DataFrame
) -> DataFrame:
    """Mean stars a local user gave a local business."""
    named = local_businesses.select(
        "business_id",
        F.col("name").alias("business_name"),
        F.col("stars").alias("business_stars"),
    )
    return (
        pair_ratings(review, local_businesses)
        .join(local_users, "user_id", "left_semi")
        .join(named, "business_id")
        .select(
            "user_id",
            "business_id",
            "business_name",
            "business_stars",
            F.try_divide("stars_sum", "stars_count").alias("avg_rev_stars"),
        )
    )


def weighted_scores(pairs: DataFrame, predictions: DataFrame) -> DataFrame:
    """Add the user's predicted expertise and its product with the mean stars."""
    scored = pairs.join(
        predictions.select("user_id", F.col("prediction").alias("elite_score")), "user_id"
    )
    return scored.select(
        *pairs.columns,
        "elite_score",
        (F.col("avg_rev_stars") * F.col("elite_score")).alias("w_score"),
    )


def business_ranks(scores: DataFrame) -> DataFrame:
    """Mean weighted score per business."""
    return scores.groupBy("business_id", "business_name", "business_stars").agg(
        F.avg("w_score").alias("rank")
    )


def in_rank_order(ranks: DataFrame) -> DataFrame:
    """Best first; equal ranks by business, so that the order is always the same."""
    return ranks.orderBy(F.desc("rank"), "business_id")


def top_ranked(ranks: DataFrame, k: int = 20) -> DataFrame:
    """The first k of the ranking, found without sorting all of it."""
    return in_rank_order(ranks).limit(k)


def local_vs_overall(
    review: DataFrame,
    business: DataFrame,
    local_businesses: DataFrame,
    local_users: DataFrame,
) -> DataFrame:
    """Overall stars of local businesses next to the mean of local users' reviews."""
    by_local_users = (
        pair_ratings(review, local_businesses)
        .join(local_users, "user_id", "left_semi")
        .groupBy("business_id")
        .agg((F.sum("stars_sum") / F.sum("stars_count")).alias("avg_rating"))
    )
    return business.select("business_id", "stars").join(by_local_users, "business_id").select(
        "business_id", "stars", "avg_rating"
    )
