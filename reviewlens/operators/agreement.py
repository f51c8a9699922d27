"""How well clusterings hold together and how far two of them agree, per user, without any pairs.

Both measures come from sums: the silhouette from the sum of the unit vectors of every cluster, the
adjusted Rand index from the table of how many visits two labels share. Every visit counts, so a
place weighs by its visits. Places without a label (noise) take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_AXES = ("x", "y", "z")


def _with_axes(rows: DataFrame) -> DataFrame:
    lat, lon = F.radians("latitude"), F.radians("longitude")
    return rows.withColumns({"x": F.cos(lat) * F.cos(lon), "y": F.cos(lat) * F.sin(lon), "z": F.sin(lat)})


def _dot(other: Column) -> Column:
    return F.col("x") * other["x"] + F.col("y") * other["y"] + F.col("z") * other["z"]


def silhouettes(labels: DataFrame) -> DataFrame:
    """(user_id, clusters, visits, silhouette): the mean over visits of (b - a) / max(a, b), a being the
    mean squared chord to the other visits of the own cluster and b the least such mean to another
    cluster. Null for users with one cluster; a visit alone in its cluster counts 0.

    ``labels`` has user_id, cluster_id, latitude, longitude, visits. A user's clusters travel as
    one array of sums, so places are neither paired nor multiplied.
    """
    # Axes follow from coordinates: they are computed behind the shuffles, not sent through them.
    spots = labels.where(F.col("cluster_id").isNotNull()).select("user_id", "cluster_id", "latitude", "longitude", "visits")
    sums = _with_axes(spots).groupBy("user_id", "cluster_id").agg(
        F.sum("visits").alias("n"), *[F.sum(F.col("visits") * F.col(axis)).alias(axis) for axis in _AXES]
    )
    of_user = sums.groupBy("user_id").agg(F.collect_list(F.struct("cluster_id", "n", *_AXES)).alias("clusters"))
    # Squared chord of unit vectors: two less twice the product, summed over a cluster's visits.
    apart = lambda c: F.lit(2.0) * c["n"] - F.lit(2.0) * _dot(c)
    own = F.get(F.filter("clusters", lambda c: c["cluster_id"] == F.col("cluster_id")), F.lit(0))
    others = F.transform(F.filter("clusters", lambda c: c["cluster_id"] != F.col("cluster_id")), lambda c: apart(c) / c["n"])
    placed = _with_axes(spots.join(of_user, "user_id")).select(
        "user_id", "visits", F.size("clusters").alias("clusters"), own.alias("own"), F.array_min(others).alias("b"), *_AXES
    )
    a = F.greatest(apart(F.col("own")) / (F.col("own.n") - 1), F.lit(0.0))
    value = F.when(F.col("own.n") <= 1, 0.0).otherwise(F.coalesce(F.try_divide(F.col("b") - a, F.greatest("b", a)), F.lit(0.0)))
    return placed.groupBy("user_id").agg(
        F.first("clusters").cast("long").alias("clusters"),
        F.sum("visits").alias("visits"),
        F.when(F.first("clusters") > 1, F.sum(value * F.col("visits")) / F.sum("visits")).alias("silhouette"),
    )


def adjusted_rand(pairs: DataFrame) -> DataFrame:
    """(user_id, visits, adjusted_rand) of two labels of the same places: ``pairs`` has user_id, one,
    two and visits. 1 for equal partitions, about 0 for unrelated ones; 1 where both have no choice.
    """
    chosen = lambda n: F.col(n) * (F.col(n) - 1) / 2.0
    kept = pairs.where(F.col("one").isNotNull() & F.col("two").isNotNull())
    cells = kept.groupBy("user_id", "one", "two").agg(F.sum("visits").alias("n"))

    def side(name: str) -> DataFrame:
        return cells.groupBy("user_id", name).agg(F.sum("n").alias("n")).groupBy("user_id").agg(F.sum(chosen("n")).alias(f"of_{name}"))

    both = cells.groupBy("user_id").agg(F.sum("n").alias("visits"), F.sum(chosen("n")).alias("shared"))
    joined = both.join(side("one"), "user_id").join(side("two"), "user_id")
    expected = F.try_divide(F.col("of_one") * F.col("of_two"), chosen("visits"))
    most = (F.col("of_one") + F.col("of_two")) / 2.0
    index = F.coalesce(F.try_divide(F.col("shared") - expected, most - expected), F.lit(1.0))
    return joined.select("user_id", "visits", index.alias("adjusted_rand"))


def by_nearest_center(places: DataFrame, centers: DataFrame) -> DataFrame:
    """Adds ``cluster_id``: the number of the user's nearest centre in their order by coordinates,
    the smaller of equal ones. Users without centres are left out."""
    spot = F.struct("latitude", "longitude", *_AXES)
    of_user = _with_axes(centers).groupBy("user_id").agg(F.array_sort(F.collect_list(spot)).alias("centers"))
    near = F.transform("centers", lambda c, i: F.struct((-_dot(c)).alias("away"), i.cast("long").alias("at")))
    return _with_axes(places.join(of_user, "user_id")).select(*places.columns, F.array_min(near)["at"].alias("cluster_id"))
