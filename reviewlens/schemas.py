"""Column types of the tables the engine reads and writes."""

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)


def _table(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


_TEXT, _LONG, _REAL = StringType(), LongType(), DoubleType()

BUSINESS = _table(
    business_id=_TEXT,
    name=_TEXT,
    stars=_REAL,
    latitude=_REAL,
    longitude=_REAL,
    categories=ArrayType(_TEXT),
    city=_TEXT,
    state=_TEXT,
)

REVIEW = _table(user_id=_TEXT, business_id=_TEXT, stars=_LONG, text=_TEXT)

USER = _table(
    user_id=_TEXT,
    name=_TEXT,
    review_count=_LONG,
    average_stars=_REAL,
    votes=_table(cool=_LONG, funny=_LONG, useful=_LONG),
    fans=_LONG,
    yelping_since=_TEXT,
    elite=ArrayType(_LONG),
)

# A map keeps one column whatever the number of slots; inference would make one field per slot.
CHECKIN = _table(business_id=_TEXT, checkin_info=MapType(_TEXT, IntegerType()))

USER_FEATURES = _table(
    user_id=_TEXT,
    name=_TEXT,
    review_count=_LONG,
    average_stars=_REAL,
    votes_cool=_LONG,
    votes_funny=_LONG,
    votes_useful=_LONG,
    months_yelping=_REAL,
    elite=_REAL,
    elite_cat=IntegerType(),
    category=_TEXT,
    cat_business_count=_LONG,
    cat_review_count=_LONG,
    cat_avg_review_len=_REAL,
    cat_avg_stars=_REAL,
)

CENTERS = _table(
    cluster_centers=ArrayType(_table(latitude=FloatType(), longitude=FloatType())),
    user_id=_TEXT,
)

PREDICTIONS = _table(user_id=_TEXT, prediction=_REAL)

WORLD_CITIES = _table(
    Country=_TEXT,
    City=_TEXT,
    AccentCity=_TEXT,
    Region=_TEXT,
    Population=_REAL,
    Latitude=_REAL,
    Longitude=_REAL,
)

ZIP_CENTROIDS = _table(zip=_TEXT, latitude=_REAL, longitude=_REAL)
