"""User-by-category features."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions import members
from reviewlens.operators.scale import broadcast_if_small, cut_lineage
from reviewlens.sources.taxonomy import category_key


def category_rows(
    business: DataFrame, parents: DataFrame, normalize: bool = False
) -> DataFrame:
    """One row per category element that has a parent; unmapped elements give no row and a
    business matching one parent twice gives two."""
    exploded = business.withColumn("sub_category", F.explode("categories"))
    keyed = exploded.withColumn("sub_category", category_key(F.col("sub_category"), normalize))
    return keyed.join(parents.select("sub_category", "category"), "sub_category")


def business_category_exploded(
    business: DataFrame, parents: DataFrame, normalize: bool = False
) -> DataFrame:
    rows = category_rows(business.select("business_id", "categories"), parents, normalize)
    return rows.select("business_id", "category")


def business_category(
    business: DataFrame, parents: DataFrame, normalize: bool = False
) -> DataFrame:
    """Distinct (business_id, category)."""
    return business_category_exploded(business, parents, normalize).distinct()


def with_review_length(review: DataFrame) -> DataFrame:
    return review.withColumn("review_len", F.length("text"))


def user_business_reviews(review: DataFrame) -> DataFrame:
    """Reviews summed up per user and business.

    Grouping on both keys spreads a busy user and a busy business alike, and all later joins
    see each pair once.
    """
    return review.groupBy("user_id", "business_id").agg(
        F.count("*").alias("reviews"),
        F.sum("review_len").alias("len_sum"),
        F.count("review_len").alias("len_count"),
        F.sum("stars").alias("stars_sum"),
        F.count("stars").alias("stars_count"),
    )


def user_category_agg(
    review: DataFrame,
    category_of_business: DataFrame,
    dedupe: bool = True,
    keep_layout: bool = False,
) -> DataFrame:
    """Businesses, reviews, mean length and mean stars per user and category.

    With ``dedupe`` a business counts once per category however many of its sub-categories
    match. Without it every match counts, which weights the review count and both means but
    not the number of businesses. Sums are whole numbers, so results do not depend on order.
    ``keep_layout``, for reviews in buckets of the user: the matches are counted first and, where
    they are few enough, broadcast, so the pairs of a user stay where they are.
    """
    matches = category_of_business.groupBy("business_id", "category").agg(
        F.count("*").alias("matches")
    )
    if keep_layout:
        matches = broadcast_if_small(cut_lineage(matches))
    times = F.lit(1) if dedupe else F.col("matches")
    pairs = user_business_reviews(with_review_length(review)).join(matches, "business_id")
    sums = pairs.groupBy("user_id", "category").agg(
        F.count("*").alias("cat_business_count"),
        F.sum(F.col("reviews") * times).alias("cat_review_count"),
        F.sum(F.col("len_sum") * times).alias("len_sum"),
        F.sum(F.col("len_count") * times).alias("len_count"),
        F.sum(F.col("stars_sum") * times).alias("stars_sum"),
        F.sum(F.col("stars_count") * times).alias("stars_count"),
    )
    return sums.select(
        "user_id",
        "category",
        "cat_business_count",
        "cat_review_count",
        F.try_divide("len_sum", "len_count").alias("cat_avg_review_len"),
        F.try_divide("stars_sum", "stars_count").alias("cat_avg_stars"),
    )


def user_attributes(user: DataFrame, as_of: datetime.date) -> DataFrame:
    """User columns of the feature table; ``elite`` becomes the score of the elite years."""
    score = members.elite_score(F.col("elite"), as_of)
    return user.select(
        "user_id",
        "name",
        "review_count",
        "average_stars",
        F.col("votes.cool").alias("votes_cool"),
        F.col("votes.funny").alias("votes_funny"),
        F.col("votes.useful").alias("votes_useful"),
        members.months_since(F.col("yelping_since"), as_of).alias("months_yelping"),
        score.alias("elite"),
    ).withColumn("elite_cat", members.elite_category(F.col("elite")))


def join_features(per_category: DataFrame, attributes: DataFrame) -> DataFrame:
    joined = attributes.join(per_category, "user_id")
    return joined.select(
        *attributes.columns,
        "category",
        "cat_business_count",
        "cat_review_count",
        "cat_avg_review_len",
        "cat_avg_stars",
    )


def user_profile_v0(user: DataFrame, as_of: datetime.date) -> DataFrame:
    """Earlier profile record; ``k`` starts at 0 and is filled by ``with_frequent_cities``."""
    return user.select(
        "user_id",
        F.col("name").alias("userName"),
        F.col("review_count").alias("totalReviews"),
        F.col("votes.funny").alias("funny"),
        F.col("votes.cool").alias("cool"),
        F.col("votes.useful").alias("useful"),
        "fans",
        members.calendar_months_since(F.col("yelping_since"), as_of).alias("yelpingSince"),
        members.elite_score_v0(F.col("elite"), as_of).alias("elite"),
        F.lit(0).cast("long").alias("k"),
    )


def with_frequent_cities(profile: DataFrame, frequent: DataFrame) -> DataFrame:
    """Fill ``k`` with the number of cities the user reviews often, 0 where there is none."""
    counted = profile.drop("k").join(frequent.select("user_id", "k"), "user_id", "left")
    return counted.withColumn("k", F.coalesce("k", F.lit(0)).cast("long"))
