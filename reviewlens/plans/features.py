"""Feature table of users and categories."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame

from reviewlens.operators import features as ops
from reviewlens.operators import visits
from reviewlens.operators.scale import apart_by_size, shared_folder
from reviewlens.sources import taxonomy as tax
from reviewlens.sources.layouts import write_bucketed

#: Reviews beyond which a user's rows stay out of the buckets.
_LARGE = 1_000_000


def user_features(
    business: DataFrame,
    review: DataFrame,
    user: DataFrame,
    taxonomy: DataFrame,
    as_of: datetime.date,
    dedupe: bool = True,
    normalize: bool = False,
    keep_layout: bool = False,
) -> DataFrame:
    """One row per user and category with the user's attributes and what they did in it.

    ``keep_layout``: reviews and users are in buckets of the user, see ``co_located``."""
    parents = tax.last_wins(taxonomy, normalize)
    rows = ops.business_category_exploded(business, parents, normalize)
    per_category = ops.user_category_agg(review, rows, dedupe, keep_layout)
    return ops.join_features(per_category, ops.user_attributes(user, as_of))


def co_located(
    review: DataFrame, user: DataFrame, buckets: int, large_user: int = _LARGE
) -> list[tuple[DataFrame, DataFrame]]:
    """Reviews and users in buckets of user_id, and beside them, in plain tables, the users with very
    many reviews and their rows, if there are any. Users without reviews are in the buckets.

    Stored once, every job that joins or groups by user reads the buckets without an exchange.
    """
    few, many = apart_by_size(review, "user_id", large_user)
    folder, name = shared_folder(review.sparkSession), f"co_located_{uuid.uuid4().hex}"
    others = user
    if many is not None:
        busy = many.select("user_id").distinct()
        others = user.join(busy, "user_id", "left_anti")
    parts = [
        tuple(
            write_bucketed(rows, f"{name}_{what}", f"{folder}/{name}_{what}", "user_id", buckets)
            for rows, what in ((few, "review"), (others, "user"))
        )
    ]
    if many is not None:
        parts.append((many, user.join(busy, "user_id", "left_semi")))
    return parts


def user_profiles_v0(
    business: DataFrame,
    review: DataFrame,
    user: DataFrame,
    as_of: datetime.date,
    more_than: int = 10,
) -> DataFrame:
    """Earlier profile record with the number of cities the user reviews often."""
    frequent = visits.frequent_cities(user, review, business, more_than)
    return ops.with_frequent_cities(ops.user_profile_v0(user, as_of), frequent)
