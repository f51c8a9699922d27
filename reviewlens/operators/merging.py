"""User-category counts as states that merge, so a day's reviews are added without the old ones.

A state row holds, per user, category and bucket of 64 business numbers, a bitmap of the businesses
reviewed, as a long, and the sums of the reviews. Bitmaps merge by OR, so a business reviewed on two
days counts once; sums merge by adding. Businesses are numbered along the Z curve of their places:
who reviews one town has few buckets, and who reviews the whole country has a row per business, so a
state never has more rows than the pairs of user and business it counts.

The categories of a business must stay what they were when its reviews were counted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.operators.features import with_review_length
from reviewlens.operators.scale import cut_lineage
from reviewlens.sources.layouts import in_place_order

KEYS = ["user_id", "category", "bucket"]
SPAN = 64  # business numbers of a bucket, as many as a long has bits
_SUMS = ["reviews", "len_sum", "len_count", "stars_sum", "stars_count"]
_ROWS_BITS = 33  # row numbers within a partition take the lower bits of an increasing id


def business_numbers(business: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(business_id, number), stored. Numbers are gapless from 0; businesses of ``known`` keep
    theirs and new ones follow. A business that occurs twice gets one."""
    spots = business.select("business_id", "latitude", "longitude").groupBy("business_id")
    rows = spots.agg(F.min("latitude").alias("latitude"), F.min("longitude").alias("longitude"))
    first = 0
    if known is not None:
        rows = rows.join(known, "business_id", "left_anti")
        highest = known.agg(F.max("number")).first()[0]
        first = 0 if highest is None else highest + 1
    # An increasing id holds the number of its partition and the row's place in it.
    ordered = in_place_order(cut_lineage(rows)).select(
        "business_id", F.monotonically_increasing_id().alias("at")
    )
    part = F.shiftright("at", _ROWS_BITS)
    placed = cut_lineage(
        ordered.select(
            "business_id", part.alias("part"), (F.col("at") - F.shiftleft(part, _ROWS_BITS)).alias("place")
        )
    )
    sizes = placed.groupBy("part").agg(F.count("*").alias("size"))  # a row per partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    number = (F.col("start") + F.col("place") + first).alias("number")
    new = placed.join(starts, "part").select("business_id", number)
    return cut_lineage(new if known is None else known.unionByName(new))


def state_of(
    review: DataFrame, category_of_business: DataFrame, numbers: DataFrame
) -> DataFrame:
    """State of a part of the reviews. ``category_of_business`` may repeat its rows.

    Narrow reviews are dealt by the state's keys before bitmaps are built, so no bitmap is
    shuffled or sorted.
    """
    matches = category_of_business.select("business_id", "category").distinct()
    placed = matches.join(numbers, "business_id").select(
        "business_id",
        "category",
        F.floor(F.col("number") / SPAN).alias("bucket"),
        F.pmod("number", F.lit(SPAN)).alias("bit"),
    )
    narrow = with_review_length(review).select("user_id", "business_id", "review_len", "stars")
    dealt = narrow.join(placed, "business_id").repartition(*KEYS)
    # Spark's bitmap has 4,096 bytes; a bucket fills the first eight.
    word = F.conv(F.hex(F.substring(F.bitmap_construct_agg("bit"), 1, SPAN // 8)), 16, -10).cast("long")
    return dealt.groupBy(*KEYS).agg(
        word.alias("businesses"),
        F.count("*").alias("reviews"),
        F.sum("review_len").alias("len_sum"),
        F.count("review_len").alias("len_count"),
        F.sum("stars").alias("stars_sum"),
        F.count("stars").alias("stars_count"),
    )


def merged(*states: DataFrame) -> DataFrame:
    """One state of several. Merging is associative and does not depend on order; the parts must
    not share reviews.

    The rows of a user and category meet by one shuffle, after which they are counted without a further
    one.
    """
    return (
        reduce(DataFrame.unionByName, states)
        .repartition("user_id", "category")
        .groupBy(*KEYS)
        .agg(
            F.bit_or("businesses").alias("businesses"),
            *(F.sum(name).alias(name) for name in _SUMS),
        )
    )


def user_category_agg(state: DataFrame) -> DataFrame:
    """The counts and means of a state, as ``features.user_category_agg`` has them of the reviews."""
    counted = state.select(
        "user_id", "category", F.bit_count("businesses").cast("long").alias("n"), *_SUMS
    )
    sums = counted.groupBy("user_id", "category").agg(
        F.sum("n").alias("cat_business_count"), *(F.sum(name).alias(name) for name in _SUMS)
    )
    return sums.select(
        "user_id",
        "category",
        "cat_business_count",
        F.col("reviews").alias("cat_review_count"),
        F.try_divide("len_sum", "len_count").alias("cat_avg_review_len"),
        F.try_divide("stars_sum", "stars_count").alias("cat_avg_stars"),
    )
