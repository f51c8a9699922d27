"""City centres and the region of a city a business lies in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions import geo


def first_city(cities: DataFrame) -> DataFrame:
    """Per lower-cased (city, region) the coordinates of its first row by ``position``."""
    first = F.min_by(F.struct("latitude", "longitude"), "position")
    return (
        cities.groupBy(F.lower("city").alias("city_key"), F.lower("region").alias("state_key"))
        .agg(first.alias("spot"))
        .select(
            "city_key",
            "state_key",
            F.col("spot.latitude").alias("city_latitude"),
            F.col("spot.longitude").alias("city_longitude"),
        )
    )


def _keyed(business: DataFrame) -> DataFrame:
    return business.withColumns({"city_key": F.lower("city"), "state_key": F.lower("state")})


def with_city_center(business: DataFrame, cities: DataFrame) -> DataFrame:
    """Businesses with the centre of their city; those without a match give no row."""
    keys = ["city_key", "state_key"]
    return _keyed(business).join(first_city(cities), keys).drop(*keys)


def city_lookup(business: DataFrame, cities: DataFrame) -> DataFrame:
    """Centre of the city of every business, null where the city is unknown."""
    return (
        _keyed(business)
        .join(first_city(cities), ["city_key", "state_key"], "left")
        .select("business_id", "city_latitude", "city_longitude")
    )


def city_no_match(business: DataFrame, cities: DataFrame) -> DataFrame:
    """Number of businesses whose city is unknown."""
    keys = ["city_key", "state_key"]
    known = first_city(cities).select(*keys)
    return _keyed(business).join(known, keys, "left_anti").agg(F.count("*").alias("no_match"))


def business_region(
    business: DataFrame, cities: DataFrame, corrected: bool = False
) -> DataFrame:
    """(business_id, stars, region, miles, degree) relative to the city centre, plus
    ``categories`` for the per-category output."""
    placed = with_city_center(business, cities)
    ends = [F.col(c) for c in ("city_latitude", "city_longitude", "latitude", "longitude")]
    measured = placed.withColumns(
        {"miles": geo.miles(*ends), "degree": geo.bearing_degrees(*ends)}
    )
    label = geo.region_label(F.col("miles"), F.col("degree"), corrected)
    return measured.select(
        "business_id", "stars", label.alias("region"), "miles", "degree", "categories"
    )


def region_rating(regions: DataFrame) -> DataFrame:
    return regions.select("business_id", "stars", "region", "miles", "degree")


def region_by_category(regions: DataFrame) -> DataFrame:
    return regions.select(
        "business_id", F.explode("categories").alias("category"), "region", "miles", "degree"
    )


def city_centroids(business: DataFrame) -> DataFrame:
    """Mean direction of the businesses of a city, as a place on the sphere."""
    lat, lon = geo.spherical_center(F.col("latitude"), F.col("longitude"), F.lit(1.0))
    return business.groupBy("city", "state").agg(lat.alias("latitude"), lon.alias("longitude"))
