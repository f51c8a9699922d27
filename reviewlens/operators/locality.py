"""Which businesses and users are local to a point or to a table of points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions import geo
from reviewlens.functions.grid import Grid
from reviewlens.sources.taxonomy import category_key


def zip_lookup(requests: DataFrame, zip_centroids: DataFrame) -> DataFrame:
    """Requests with the coordinates of their zip; an unknown zip gives no row."""
    return requests.join(zip_centroids.select("zip", "latitude", "longitude"), "zip")


def relevant_businesses(
    business: DataFrame, members: DataFrame, normalize: bool = False
) -> DataFrame:
    """Distinct (business_id, category) by taxonomy membership."""
    return (
        business.select("business_id", F.explode("categories").alias("sub_category"))
        .withColumn("sub_category", category_key(F.col("sub_category"), normalize))
        .join(members, "sub_category")
        .select("business_id", "category")
        .distinct()
    )


def local_businesses(
    business: DataFrame,
    members: DataFrame,
    category: str,
    center: tuple[float, float],
    radius_miles: float = 5.0,
    normalize: bool = False,
) -> DataFrame:
    """Businesses within the radius (limit included) with a sub-category of the category.

    The box test on literals reaches the scan; only the businesses left are matched.
    """
    nearby = business.where(
        geo.within_miles(F.col("latitude"), F.col("longitude"), center, radius_miles)
    )
    wanted = members.where(F.col("category") == category).select("sub_category")
    return (
        nearby.select("business_id", "name", "stars", F.explode("categories").alias("sub_category"))
        .withColumn("sub_category", category_key(F.col("sub_category"), normalize))
        .join(wanted, "sub_category", "left_semi")
        .select("business_id", "name", "stars")
        .distinct()
    )


def local_users(
    centers: DataFrame, center: tuple[float, float], radius_miles: float = 5.0
) -> DataFrame:
    """Users with a home area strictly within the radius. ``centers`` has one row per area."""
    near = geo.within_miles(
        F.col("latitude"), F.col("longitude"), center, radius_miles, inclusive=False
    )
    return centers.where(near).select("user_id").distinct()


def local_users_of_arrays(
    centers: DataFrame, center: tuple[float, float], radius_miles: float = 5.0
) -> DataFrame:
    """The same on stored home areas, one array per user: no explode and no shuffle."""
    near = F.exists(
        "cluster_centers",
        lambda c: geo.within_miles(
            c["latitude"], c["longitude"], center, radius_miles, inclusive=False
        ),
    )
    return centers.where(near).select("user_id")


def near_points(
    points: DataFrame, places: DataFrame, radius_miles: float, inclusive: bool = True
) -> DataFrame:
    """Join of two tables with coordinates by distance, through grid cells.

    Each point is listed under the few cells its circle touches, each place under its own, so
    the range condition becomes an equality join. Result: the points' and places' columns
    without coordinates; the names must differ.
    """
    grid = Grid(radius_miles)
    left = grid.near_cells(geo.with_vector(points, "p"), radius_miles)
    right = geo.with_vector(places, "q").withColumn(
        "cell", grid.cell(F.col("latitude"), F.col("longitude"))
    )
    ends = geo.vector_columns("p"), geo.vector_columns("q")
    near = geo.near_between(*ends, radius_miles, inclusive)
    spot = {"latitude", "longitude"}
    keep = [c for c in points.columns if c not in spot] + [c for c in places.columns if c not in spot]
    joined = left.drop(*spot).join(right.drop(*spot), "cell").where(near)
    return joined.select(*keep)
