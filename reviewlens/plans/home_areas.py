"""Home areas of users by three methods, each one row per area with its coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.operators import dense_exemplars, density, exemplars, mixture
from reviewlens.operators.scale import cut_lineage
from reviewlens.operators.scoring import pair_ratings
from reviewlens.operators.visits import user_places


def by_density(
    review: DataFrame, business: DataFrame, eps_miles: float = 4.0, min_visits: int = 5
) -> DataFrame:
    labels = density.density_labels(user_places(review, business), eps_miles, min_visits)
    return density.density_centers(labels)


def of_raters(
    review: DataFrame,
    business: DataFrame,
    wanted: DataFrame,
    eps_miles: float = 4.0,
    min_visits: int = 5,
) -> DataFrame:
    """Density centres of the users who rated one of the wanted businesses.

    A user's centres hang on the user's own reviews only, so a request about a few businesses
    clusters the few users who can have a say in it; for them the result is that of
    :func:`by_density`.
    """
    users = cut_lineage(pair_ratings(review, wanted).select("user_id").distinct())
    return by_density(review.join(users, "user_id", "left_semi"), business, eps_miles, min_visits)


def versioned(centers: DataFrame, version: int) -> DataFrame:
    """Centres as a table that is kept: ``version`` is the run that found a user's centres."""
    return centers.withColumn("version", F.lit(version))


def refreshed(
    kept: DataFrame,
    arrived: DataFrame,
    review: DataFrame,
    business: DataFrame,
    version: int,
    eps_miles: float = 4.0,
    min_visits: int = 5,
) -> DataFrame:
    """The kept centres brought up to date after reviews ``arrived``, which ``review`` holds too.

    A user's centres hang on the user's own reviews only, so just the users with new reviews are
    clustered again, over all their reviews; the others' rows stay as they are, with their version.
    The work is that of the users with news, and the result that of :func:`by_density` over all.
    """
    users = cut_lineage(arrived.select("user_id").where(F.col("user_id").isNotNull()).distinct())
    own = review.join(users, "user_id", "left_semi")
    fresh = versioned(by_density(own, business, eps_miles, min_visits), version)
    return kept.join(users, "user_id", "left_anti").unionByName(fresh)


def by_mixture(review: DataFrame, business: DataFrame, max_rounds: int = 100) -> DataFrame:
    models = mixture.mixture_models(user_places(review, business), max_rounds=max_rounds)
    return mixture.mixture_centers(models)


def by_exemplars(review: DataFrame, business: DataFrame, max_rounds: int = 200) -> DataFrame:
    return exemplars.exemplar_centers(user_places(review, business), max_rounds=max_rounds)


def by_all_pairs(review: DataFrame, business: DataFrame, max_rounds: int = 200) -> DataFrame:
    """Exemplars over all pairs of a user's places; work grows with the square of a user's places."""
    return dense_exemplars.dense_exemplar_centers(user_places(review, business), max_rounds=max_rounds)
