"""Check-in totals and the category vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.members import map_total


def checkin_totals(checkin: DataFrame) -> DataFrame:
    return checkin.select("business_id", map_total(F.col("checkin_info")).alias("tc"))


def stars_vs_checkins(business: DataFrame, checkin: DataFrame) -> DataFrame:
    totals = checkin_totals(checkin)
    return business.select("business_id", "stars").join(totals, "business_id").select(
        "business_id", F.col("stars").alias("avg_rating"), F.col("tc").alias("num_checkins")
    )


def all_categories(business: DataFrame) -> DataFrame:
    """Every category name any business carries, once."""
    return business.select(F.explode("categories").alias("category")).distinct()
