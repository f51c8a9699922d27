"""Local ranking, for one request or a table of requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.operators import locality, scoring
from reviewlens.operators.scale import cut_lineage
from reviewlens.plans import home_areas
from reviewlens.sources import taxonomy as tax
from reviewlens.sources.readers import predictions_for_category


def _stored(businesses: DataFrame) -> DataFrame:
    """The businesses in question, found once: they filter the reviews and name the result."""
    return cut_lineage(businesses)


def rank_businesses(
    business: DataFrame,
    review: DataFrame,
    centers: DataFrame,
    predictions: DataFrame,
    taxonomy: DataFrame,
    category: str,
    center: tuple[float, float],
    radius_miles: float = 5.0,
    top: int | None = None,
) -> DataFrame:
    """Businesses of a category near a point, best first, by the mean over local users of their
    mean stars times their predicted expertise. ``top`` keeps the first few only."""
    members = tax.membership(taxonomy)
    nearby = _stored(locality.local_businesses(business, members, category, center, radius_miles))
    locals_ = locality.local_users(centers, center, radius_miles)
    pairs = scoring.local_user_business(review, nearby, locals_)
    scores = scoring.weighted_scores(pairs, predictions_for_category(predictions, category))
    ranks = scoring.business_ranks(scores)
    return scoring.in_rank_order(ranks) if top is None else scoring.top_ranked(ranks, top)


def local_vs_overall_rating(
    business: DataFrame,
    review: DataFrame,
    centers: DataFrame,
    taxonomy: DataFrame,
    category: str,
    center: tuple[float, float],
    radius_miles: float = 0.5,
) -> DataFrame:
    members = tax.membership(taxonomy)
    nearby = _stored(locality.local_businesses(business, members, category, center, radius_miles))
    locals_ = locality.local_users(centers, center, radius_miles)
    return scoring.local_vs_overall(review, business, nearby, locals_)


def rank_batch(
    requests: DataFrame,
    zip_centroids: DataFrame,
    business: DataFrame,
    review: DataFrame,
    centers: DataFrame | None,
    predictions: DataFrame,
    taxonomy: DataFrame,
    radius_miles: float = 5.0,
) -> DataFrame:
    """The ranking of every distinct (zip, category) request: (zip, category, business_id,
    business_name, business_stars, rank).

    Without stored ``centers``, those of the users who rated a business in question are found by
    density. Nearness is worked out once per zip, not per request. Ratings of a user for a business are
    summed up before they meet the zips, and so are the scores per zip and category after.
    """
    asked = requests.select("zip", "category").distinct()
    zips = locality.zip_lookup(asked.select("zip").distinct(), zip_centroids)
    spots = business.select("business_id", "latitude", "longitude")
    near_business = locality.near_points(zips, spots, radius_miles)
    relevant = locality.relevant_businesses(business, tax.membership(taxonomy))
    wanted = _stored(near_business.join(relevant, "business_id").join(asked, ["zip", "category"]))
    found = wanted.select("business_id").distinct()
    if centers is None:
        centers = home_areas.of_raters(review, business, found)
    near_user = locality.near_points(
        zips, centers.select("user_id", "latitude", "longitude"), radius_miles, inclusive=False
    ).distinct()
    ratings = (
        scoring.pair_ratings(review, found)
        .withColumn("avg_rev_stars", F.try_divide("stars_sum", "stars_count"))
        .select("user_id", "business_id", "avg_rev_stars")
    )
    scores = (
        ratings.join(wanted, "business_id")
        .join(near_user, ["zip", "user_id"], "left_semi")
        .join(predictions.select("user_id", "category", "prediction"), ["user_id", "category"])
        .groupBy("zip", "category", "business_id")
        .agg(F.avg(F.col("avg_rev_stars") * F.col("prediction")).alias("rank"))
    )
    named = business.select(
        "business_id",
        F.col("name").alias("business_name"),
        F.col("stars").alias("business_stars"),
    )
    return scores.join(named, "business_id").select(
        "zip", "category", "business_id", "business_name", "business_stars", "rank"
    )
