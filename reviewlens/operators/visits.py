"""Where users have been: joins of reviews to places and the counts built on them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions import geo, geo_arrays
from reviewlens.functions.grid import Grid
from reviewlens.operators import whole_users
from reviewlens.operators.scale import apart_by_size, cut_lineage, split_hot_groups


def user_locations(review: DataFrame, business: DataFrame) -> DataFrame:
    """Coordinates of every review."""
    spots = business.select("business_id", "latitude", "longitude")
    return review.select("user_id", "business_id").join(spots, "business_id").select(
        "user_id", "latitude", "longitude"
    )


def user_places(review: DataFrame, business: DataFrame) -> DataFrame:
    """Distinct coordinates per user: (user_id, place_id, latitude, longitude, visits).

    The narrow business columns meet the reviews first, so that visits are summed once, partly
    before their only shuffle. ``place_id`` is the smallest business there.
    """
    spots = business.select("business_id", "latitude", "longitude").where(
        F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    )
    return (
        review.select("user_id", "business_id")
        .join(spots, "business_id")
        .groupBy("user_id", "latitude", "longitude")
        .agg(F.min("business_id").alias("place_id"), F.count("*").alias("visits"))
        .select("user_id", "place_id", "latitude", "longitude", "visits")
    )


def locations_per_user(places: DataFrame, target_rows: int = 10_000) -> DataFrame:
    """Places of a user as an array, in several rows (``part`` of ``parts``) for users with
    more places than the target, so that no row grows without bound."""
    spot = F.struct("latitude", "longitude", "visits")
    return (
        split_hot_groups(places, "user_id", ["latitude", "longitude"], target_rows)
        .groupBy("user_id", "part", "parts")
        .agg(F.array_sort(F.collect_list(spot)).alias("user_locations"))
    )


def near_pairs(
    places: DataFrame, radius_miles: float, large_user: int = whole_users.LARGE
) -> DataFrame:
    """Pairs of places of one user within the radius, each pair once (place_a < place_b).

    Places meet within a task, or behind joins of cells for users with more than ``large_user``
    places. Two places of one cell are a pair if their ids differ.
    """
    columns = ["user_id", "place_id", "latitude", "longitude"]
    known = cut_lineage(places.select(*columns).dropna(subset=["user_id", "latitude", "longitude"]))
    ordinary, large = apart_by_size(known, "user_id", large_user)
    pairs = _near_pairs_of_whole_users(ordinary, radius_miles)
    return pairs if large is None else pairs.union(_near_pairs_by_cells(large, radius_miles))


def _near_pairs_of_whole_users(places: DataFrame, radius_miles: float) -> DataFrame:
    cell = Grid(radius_miles).cell(F.col("latitude"), F.col("longitude"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_users.few_users(batches):
            at = tuple(whole_users.numbers(table, f"v{axis}") for axis in "xyz")
            home = table["home"].to_numpy()
            firsts = whole_users.starts_of(table, "user_id", "place_id")
            node = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, table.num_rows)))
            unnamed = table["place_id"].is_null().to_numpy()
            i, k = whole_users.later_pairs(starts, table.num_rows)
            kept = geo_arrays.near(at, i, k, radius_miles)
            i, k = i[kept], k[kept]
            kept = (home[i] != home[k]) | ((node[i] != node[k]) & ~unnamed[i])  # sorted, nulls first
            i, k = i[kept], k[kept]
            ends = (np.where(unnamed[i], k, i), k)
            found = [table["user_id"].take(pa.array(i)), *(table["place_id"].take(pa.array(end)) for end in ends)]
            found.append(pa.array(geo_arrays.miles(at, i, k)))
            pairs = pa.table(found, ["user_id", "place_a", "place_b", "miles"])
            yield from pairs.combine_chunks().to_batches()

    user, place = (places.schema[name].dataType.simpleString() for name in ("user_id", "place_id"))
    spots = geo.with_vector(whole_users.dealt(places, "place_id")).withColumn("home", cell)
    return spots.mapInArrow(run, f"user_id {user}, place_a {place}, place_b {place}, miles double")


def _near_pairs_by_cells(places: DataFrame, radius_miles: float) -> DataFrame:
    """Cells are as wide as the radius, so only places of neighbouring cells meet and a fixed share
    of what meets is within the radius: candidates stay in proportion to the pairs returned. A
    place looks at its own cell and the later ones only, as the earlier ones look at it.
    """
    grid = Grid(radius_miles)
    spots = geo.with_vector(
        places.repartition("user_id", "place_id")
    ).withColumn("home", grid.cell(F.col("latitude"), F.col("longitude")))
    left = (
        grid.near_cells(spots, radius_miles)
        .where(F.col("cell") >= F.col("home"))
        .select(
            "user_id",
            "home",
            F.col("place_id").alias("one"),
            *(F.col(f"v{axis}").alias(f"a{axis}") for axis in "xyz"),
            "cell",
        )
    )
    right = spots.select(
        "user_id",
        F.col("place_id").alias("other"),
        *(F.col(f"v{axis}").alias(f"b{axis}") for axis in "xyz"),
        F.col("home").alias("cell"),
    )
    ends = geo.vector_columns("a"), geo.vector_columns("b")
    once = (F.col("home") < F.col("cell")) | (F.col("one") < F.col("other"))
    return (
        left.join(right, ["user_id", "cell"])
        .where(once & geo.near_between(*ends, radius_miles))
        .select(
            "user_id",
            F.least("one", "other").alias("place_a"),
            F.greatest("one", "other").alias("place_b"),
            geo.miles_between(*ends).alias("miles"),
        )
    )


def near_counts(
    places: DataFrame, radius_miles: float, large_user: int = whole_users.LARGE
) -> DataFrame:
    """Per place the number of the user's other places within the radius and their visits:
    (user_id, place_id, near_places, near_visits). Neighbours are summed where they are found: within
    a task, or behind joins of cells for users with more than ``large_user`` places."""
    columns = ["user_id", "place_id", "latitude", "longitude", "visits"]
    known = cut_lineage(places.select(*columns).dropna(subset=["user_id", "latitude", "longitude"]))
    ordinary, large = apart_by_size(known, "user_id", large_user)
    counts = _near_counts_of_whole_users(ordinary, radius_miles)
    return counts if large is None else counts.union(_near_counts_by_cells(large, radius_miles))


def _near_counts_of_whole_users(places: DataFrame, radius_miles: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_users.few_users(batches):
            number = whole_users.numbers
            at = geo_arrays.unit_vectors(number(table, "latitude"), number(table, "longitude"))
            i, k = whole_users.all_pairs(starts, table.num_rows)
            firsts = whole_users.starts_of(table, "user_id", "place_id")
            node = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, table.num_rows)))
            kept = (node[i] != node[k]) & geo_arrays.near(at, i, k, radius_miles)
            i, k = node[i[kept]], k[kept]
            sums = np.bincount(i, minlength=len(firsts)), np.bincount(i, number(table, "visits")[k], len(firsts))
            names = table.select(["user_id", "place_id"]).take(pa.array(firsts)).combine_chunks()
            for name, sum_ in zip(("near_places", "near_visits"), sums):
                names = names.append_column(name, pa.array(sum_.astype(np.int64)))
            yield from names.combine_chunks().to_batches()

    kinds = {name: places.schema[name].dataType.simpleString() for name in ("user_id", "place_id")}
    schema = ", ".join(f"{name} {kind}" for name, kind in kinds.items()) + ", near_places long, near_visits long"
    return whole_users.dealt(places, "place_id").mapInArrow(run, schema)


def _near_counts_by_cells(places: DataFrame, radius_miles: float) -> DataFrame:
    grid = Grid(radius_miles)
    spots = geo.with_vector(places.repartition("user_id", "place_id"))
    left = grid.near_cells(spots, radius_miles).select(
        "user_id", "place_id", *(F.col(f"v{axis}").alias(f"a{axis}") for axis in "xyz"), "cell"
    )
    right = spots.select(
        "user_id",
        F.col("place_id").alias("other"),
        F.col("visits").alias("met"),
        *(F.col(f"v{axis}").alias(f"b{axis}") for axis in "xyz"),
        grid.cell(F.col("latitude"), F.col("longitude")).alias("cell"),
    )
    ends = geo.vector_columns("a"), geo.vector_columns("b")
    other = F.col("place_id") != F.col("other")
    return (
        left.join(right, ["user_id", "cell"])
        .where(geo.near_between(*ends, radius_miles))
        .groupBy("user_id", "place_id")
        .agg(
            F.count_if(other).alias("near_places"),
            F.coalesce(F.sum(F.when(other, F.col("met"))), F.lit(0)).alias("near_visits"),
        )
    )


def visits_by(review: DataFrame, business: DataFrame, *place_columns: str) -> DataFrame:
    """Review counts per user and the given business columns (city, or city and state).

    Joined first and counted once: where the business side is broadcast, the reviews are never
    shuffled, only their partial counts.
    """
    where = business.select("business_id", *place_columns)
    return (
        review.select("user_id", "business_id")
        .join(where, "business_id")
        .groupBy("user_id", *place_columns)
        .agg(F.count("*").alias("count"))
    )


def frequent_cities(
    users: DataFrame, review: DataFrame, business: DataFrame, more_than: int = 10
) -> DataFrame:
    """Per user the number of (city, state) groups with more reviews than given, 0 if none."""
    often = (
        visits_by(review, business, "city", "state")
        .where(F.col("count") > more_than)
        .groupBy("user_id")
        .agg(F.count("*").alias("k"))
    )
    return (
        users.select("user_id")
        .join(often, "user_id", "left")
        .select("user_id", F.coalesce("k", F.lit(0)).cast("long").alias("k"))
    )


def places_per_user(review: DataFrame, business: DataFrame) -> DataFrame:
    """Number of reviews of a user that have a known place."""
    return (
        review.select("user_id", "business_id")
        .join(business.select("business_id"), "business_id", "left_semi")
        .groupBy("user_id")
        .agg(F.count("*").alias("count"))
    )


def average_rating_per_user(review: DataFrame) -> DataFrame:
    return review.groupBy("user_id").agg(F.avg("stars").alias("avg_rating"))


def distinct_users(rows: DataFrame, user_id=None) -> DataFrame:
    """Distinct user ids, of one user only if given."""
    chosen = rows if user_id is None else rows.where(F.col("user_id") == user_id)
    return chosen.select("user_id").distinct()
