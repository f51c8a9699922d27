"""Businesses, reviews, users and the rest, derived by Spark from the driver's star schema.

Users are customers, businesses are parts and reviews are line items of their orders.
"""

from __future__ import annotations

import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.functions.members import elite_score
from reviewlens.operators.expertise import CATEGORIES

AS_OF = datetime.date(2002, 1, 15)
YEAR_BEFORE = datetime.date(2001, 1, 15)
ZIP = "00000"
CENTER = (30.15, -119.85)

# Taxonomy lines in order. Two sub-categories belong to two parents.
TAXONOMY_LINES = [
    ("Restaurants", ["ECONOMY", "SMALL", "Brand#1", "PROMO"]),
    ("Shopping", ["LARGE", "Brand#2", "Brand#3"]),
    ("Beauty and Spa", ["MEDIUM", "Brand#3"]),
    ("Health and Medical", ["PROMO", "Brand#4"]),
]


def _values(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """A tiny dimension as a literal relation, whose size Spark knows."""
    text = ", ".join(
        "(" + ", ".join(f"'{v}'" if isinstance(v, str) else f"{v!r}D" if isinstance(v, float) else str(v) for v in row) + ")"
        for row in rows
    )
    return spark.sql(f"SELECT * FROM VALUES {text} AS t({columns})")


class Tables:
    """Lazily built tables over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def nation_region(self) -> DataFrame:
        nation, region = self.source("nation"), self.source("region")
        return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))

    @cached_property
    def business(self) -> DataFrame:
        key = F.col("p_partkey")
        metro = key % 5
        latitude = F.lit(30.0) + metro * 3.0 + ((key * 7919) % 1000) * 3e-4
        longitude = F.lit(-120.0) + metro * 8.0 + ((key * 104729) % 997) * 3e-4
        return (
            self.source("part")
            .join(self.nation_region, F.col("n_nationkey") == key % 25)
            .select(
                key.alias("business_id"),
                F.col("p_name").alias("name"),
                (F.lit(1.0) + (F.col("p_size") % 9) * 0.5).alias("stars"),
                latitude.alias("latitude"),
                longitude.alias("longitude"),
                F.array_sort(F.array("p_type", "p_brand")).alias("categories"),
                F.col("n_name").alias("city"),
                F.col("r_name").alias("state"),
            )
        )

    @cached_property
    def review(self) -> DataFrame:
        """Stars are worked out before the join: above it only names change, so that a filter by
        business is pushed below and line items it drops are never shuffled."""
        orders = self.source("orders")
        text = F.concat("o_orderpriority", F.lit(" "), "l_returnflag", "l_linestatus")
        stars = (F.lit(1) + F.col("l_quantity").cast("int") % 5).cast("long")
        return (
            self.source("lineitem")
            .select("l_orderkey", "l_partkey", stars.alias("stars"), "l_returnflag", "l_linestatus")
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.col("o_custkey").alias("user_id"),
                F.col("l_partkey").alias("business_id"),
                "stars",
                text.alias("text"),
            )
        )

    @cached_property
    def user(self) -> DataFrame:
        orders = self.source("orders")
        reviewed = self.review.groupBy("user_id").agg(
            F.count("*").alias("review_count"), F.avg("stars").alias("average_stars")
        )
        votes = self.source("events").groupBy("user_id").agg(
            *(
                F.count(F.when(F.col("event_type") == kind, 1)).alias(name)
                for name, kind in (("cool", "click"), ("funny", "view"), ("useful", "purchase"))
            )
        )
        big = F.when(F.col("o_totalprice") > 300000, F.year("o_orderdate").cast("long"))
        ordered = orders.groupBy(F.col("o_custkey").alias("user_id")).agg(
            F.date_format(F.min("o_orderdate"), "yyyy-MM").alias("yelping_since"),
            F.array_sort(F.collect_set(big)).alias("elite"),
        )
        zero = F.lit(0).cast("long")
        return (
            self.source("customer")
            .select(
                F.col("c_custkey").alias("user_id"),
                F.col("c_name").alias("name"),
                F.col("c_nationkey").cast("long").alias("fans"),
            )
            .join(reviewed, "user_id", "left")
            .join(votes, "user_id", "left")
            .join(ordered, "user_id", "left")
            .select(
                "user_id",
                "name",
                F.coalesce("review_count", zero).alias("review_count"),
                F.coalesce("average_stars", F.lit(0.0)).alias("average_stars"),
                F.struct(
                    *(F.coalesce(n, zero).alias(n) for n in ("cool", "funny", "useful"))
                ).alias("votes"),
                "fans",
                "yelping_since",
                F.coalesce("elite", F.array().cast("array<bigint>")).alias("elite"),
            )
        )

    @cached_property
    def checkin(self) -> DataFrame:
        """Slots are hours of week days, so a business's map is bounded."""
        slot = F.concat_ws("-", F.hour("ts"), F.dayofmonth("ts") % 7)
        return (
            self.source("events")
            .groupBy((F.col("event_id") % 200).alias("business_id"), slot.alias("slot"))
            .agg(F.count("*").cast("int").alias("n"))
            .groupBy("business_id")
            .agg(F.map_from_entries(F.collect_list(F.struct("slot", "n"))).alias("checkin_info"))
        )

    @cached_property
    def taxonomy(self) -> DataFrame:
        rows = [
            (number, parent, sub)
            for number, (parent, subs) in enumerate(TAXONOMY_LINES, 1)
            for sub in subs
        ]
        return _values(self.spark, "position, category, sub_category", rows)

    @cached_property
    def zip_centroids(self) -> DataFrame:
        rows = [(f"0000{m}", 30.15 + 3 * m, -119.85 + 8 * m) for m in range(5)]
        rows = [(z, round(lat, 2), round(lon, 2)) for z, lat, lon in rows]
        return _values(self.spark, "zip, latitude, longitude", rows)

    @cached_property
    def requests(self) -> DataFrame:
        """What each customer asks for: a zip and one of the modelled categories."""
        pick = F.element_at(F.array(*map(F.lit, CATEGORIES)), (F.col("c_custkey") % 4 + 1).cast("int"))
        return self.source("customer").select(
            F.col("c_custkey").alias("user_id"),
            F.concat(F.lit("0000"), (F.col("c_custkey") % 5).cast("string")).alias("zip"),
            pick.alias("category"),
        )

    @cached_property
    def cities(self) -> DataFrame:
        def rows(position: Column, latitude: Column, longitude: Column) -> list[Column]:
            return [
                position.alias("position"),
                F.col("n_name").alias("city"),
                F.col("r_name").alias("region"),
                latitude.alias("latitude"),
                longitude.alias("longitude"),
            ]

        key = F.col("n_nationkey")
        known = self.nation_region.where(key < 23).select(
            *rows(key + 1, F.lit(30.15) + (key % 5) * 3.0, F.lit(-119.85) + (key % 5) * 8.0)
        )
        later = self.nation_region.where(key < 3).select(
            *rows(key + 100, F.lit(0.0), F.lit(0.0))
        )
        return known.union(later)

    @cached_property
    def predictions(self) -> DataFrame:
        """Stand-in for model output: every user's score in every modelled category, higher by
        one from category to category, so that a wrong category shows in the results."""
        return self.user.select(
            "user_id",
            elite_score(F.col("elite"), AS_OF).alias("score"),
            F.posexplode(F.array(*map(F.lit, CATEGORIES))).alias("place", "category"),
        ).select("user_id", (F.col("score") + F.col("place")).alias("prediction"), "category")
