"""Expressions on hand-made rows, limits included."""

import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlens.functions import geo, geo_arrays, members
from reviewlens.functions.grid import Grid

AS_OF = datetime.date(2016, 3, 10)


def values(df, expression):
    return [row[0] for row in df.select(expression).collect()]


def python_miles(lat1, lon1, lat2, lon2):
    f = 1 / 298.257223563
    b1, b2 = (math.atan((1 - f) * math.tan(math.radians(v))) for v in (lat1, lat2))
    h = math.sin((b2 - b1) / 2) ** 2 + math.cos(b1) * math.cos(b2) * math.sin(
        math.radians(lon2 - lon1) / 2
    ) ** 2
    s = 2 * math.asin(min(1, math.sqrt(h)))
    if s == 0:
        return 0.0
    p, q = (b1 + b2) / 2, (b2 - b1) / 2
    x = (s - math.sin(s)) * (math.sin(p) * math.cos(q) / math.cos(s / 2)) ** 2
    y = (s + math.sin(s)) * (math.cos(p) * math.sin(q) / math.sin(s / 2)) ** 2
    return 6378137 / 1609.344 * (s - f / 2 * (x + y))


POINTS = [
    (33.45, -112.07, 33.50, -112.10),
    (45.52, -73.57, 45.52, -73.57),
    (0.0, 179.99, 0.0, -179.99),
    (55.95, -3.19, 33.45, -112.07),
    (89.99, 10.0, 89.99, -170.0),
    (-33.9, 151.27, -33.91, 151.28),
]


def test_both_distance_forms(spark):
    df = spark.createDataFrame(POINTS, "a double, b double, c double, d double")
    ends = [F.col(c) for c in "abcd"]
    expected = [python_miles(*p) for p in POINTS]
    assert values(df, geo.miles(*ends)) == pytest.approx(expected, abs=1e-9)
    vectors = geo.unit_vector(*ends[:2]), geo.unit_vector(*ends[2:])
    assert values(df, geo.miles_between(*vectors)) == pytest.approx(expected, abs=1e-7)


def test_known_geodesic(spark):
    # one degree of longitude on the equator is a circle arc of the equatorial radius
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0)], "a double, b double, c double, d double")
    arc = math.radians(1) * 6378137 / 1609.344
    assert values(df, geo.miles(*[F.col(c) for c in "abcd"]))[0] == pytest.approx(arc, rel=1e-9)


def test_radius_limit_is_included_or_not(spark):
    df = spark.createDataFrame([(45.52, -73.57), (45.56, -73.57)], "lat double, lon double")
    exact = df.select(
        geo.miles(F.lit(45.52), F.lit(-73.57), F.col("lat"), F.col("lon")).alias("m")
    ).collect()[1]["m"]
    test = lambda r, inclusive: values(
        df, geo.within_miles(F.col("lat"), F.col("lon"), (45.52, -73.57), r, inclusive)
    )
    assert test(exact, True) == [True, True]
    assert test(exact, False) == [True, False]
    assert test(exact * (1 - 1e-9), True) == [True, False]


def test_radius_across_date_line_and_pole(spark):
    rows = [(0.0, -179.99), (0.0, 179.0), (89.995, -100.0), (60.0, 0.0)]
    df = spark.createDataFrame(rows, "lat double, lon double")
    near = lambda center: values(
        df, geo.within_miles(F.col("lat"), F.col("lon"), center, 5.0)
    )
    assert near((0.0, 179.99)) == [True, False, False, False]
    assert near((89.995, 80.0)) == [False, False, True, False]


def test_cells_hold_every_neighbour(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    lat = np.concatenate([rng.uniform(-90, 90, 400), [90.0, -90.0, 89.99, 0.0, 0.0, 51.0]])
    lon = np.concatenate([rng.uniform(-180, 180, 400), [0.0, 10.0, -180.0, 180.0, -180.0, 179.999]])
    turn, step = rng.uniform(0, 2 * np.pi, lat.size), rng.uniform(0, 0.999, lat.size) * 4.0 / 69.5
    lat2 = np.clip(lat + step * np.cos(turn), -90, 90)
    lon2 = lon + step * np.sin(turn) / np.maximum(np.cos(np.radians(np.maximum(abs(lat), abs(lat2)))), 1e-3)
    lon2 = (lon2 + 180) % 360 - 180
    rows = [tuple(map(float, r)) for r in zip(lat, lon, lat2, lon2)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    df = df.withColumn("id", F.monotonically_increasing_id())
    for grid in (Grid(4.0), Grid.with_diagonal(4.0), Grid(1.0)):
        listed = grid.near_cells(df, 4.0, "cell", "a", "b")
        assert listed.columns == [*df.columns, "cell"]
        checked = (
            listed.withColumn("hit", (F.col("cell") == grid.cell(F.col("c"), F.col("d"))).cast("int"))
            .groupBy("id", *"abcd")
            .agg(F.sum("hit").alias("hits"), F.count("*").alias("n"), F.countDistinct("cell").alias("u"))
            .withColumn("miles", geo.miles(*[F.col(c) for c in "abcd"]))
            .collect()
        )
        near = [row for row in checked if row["miles"] <= 4.0]
        assert len(near) > 300
        assert all(row["hits"] == 1 for row in near)
        assert all(row["n"] == row["u"] for row in checked)


def test_cell_diagonal(spark):
    df = spark.range(4000).select(
        (F.rand(1) * 178 - 89).alias("lat"), (F.rand(2) * 360 - 180).alias("lon")
    )
    grid = Grid.with_diagonal(300.0)
    placed = geo.with_vector(
        df.withColumn("cell", grid.cell(F.col("lat"), F.col("lon"))), "v", "lat", "lon"
    )
    other = placed.select("cell", *(F.col(f"v{a}").alias(f"w{a}") for a in "xyz"))
    widest = placed.join(other, "cell").agg(
        F.max(geo.miles_between(geo.vector_columns("v"), geo.vector_columns("w")))
    )
    assert widest.first()[0] <= 300.0


@pytest.mark.parametrize(
    "degree, literal, compass",
    [
        (-180.0, "west", "south"),
        (-135.0, "west", "south"),
        (-134.9, "south", "west"),
        (-45.0, "south", "west"),
        (-44.9, "east", "north"),
        (45.0, "east", "north"),
        (45.1, "north", "east"),
        (135.0, "north", "east"),
        (135.1, "west", "south"),
        (180.0, "west", "south"),
    ],
)
def test_region_limits(spark, degree, literal, compass):
    df = spark.createDataFrame([(3.0001, degree), (3.0, degree)], "m double, d double")
    assert values(df, geo.region_label(F.col("m"), F.col("d"))) == [literal, "central"]
    assert values(df, geo.region_label(F.col("m"), F.col("d"), corrected=True))[0] == compass


def test_elite_scores(spark):
    years = [[2010, 2011, 2015], [], None, [2016]]
    df = spark.createDataFrame([(y,) for y in years], "elite array<bigint>")

    def expected(ys):
        return sum(y / (2017.0 - y) for y in ys) / sum(ys) if ys else 0.0

    scores = values(df, members.elite_score(F.col("elite"), AS_OF))
    assert scores == [expected(years[0]), 0.0, 0.0, 1.0]
    whole = values(df, members.elite_score_v0(F.col("elite"), AS_OF))
    assert whole == [2010 // 7 + 2011 // 6 + 2015 // 2, 0, 0, 2016]


def test_elite_category(spark):
    df = spark.createDataFrame([(0.0,), (0.049,), (0.15,), (1.0,)], "s double")
    expected = [math.floor(x / 0.05) for x in (0.0, 0.049, 0.15, 1.0)]
    assert values(df, members.elite_category(F.col("s"))) == expected


def test_months(spark):
    df = spark.createDataFrame([("2012-03",), ("2016-03",), ("bad",), (None,)], "since string")
    assert values(df, members.months_since(F.col("since"), AS_OF)) == [48.0, 0.0, None, None]
    calendar = values(df, members.calendar_months_since(F.col("since"), AS_OF))
    assert calendar == [48, 0, None, None]


def test_map_total_and_slug(spark):
    df = spark.createDataFrame([({"9-1": 2, "10-1": None, "3-4": 5},), ({},)], "m map<string,int>")
    assert values(df, members.map_total(F.col("m"))) == [7, 0]
    slug = values(spark.range(1), members.category_slug(F.lit("Beauty and Spa")))
    assert slug == ["beauty_and_spa"]


def test_spherical_center_crosses_date_line(spark):
    df = spark.createDataFrame([(10.0, 179.0, 1), (10.0, -179.0, 1)], "lat double, lon double, w int")
    lat, lon = geo.spherical_center(F.col("lat"), F.col("lon"), F.col("w"))
    row = df.agg(lat.alias("lat"), lon.alias("lon")).first()
    assert abs(row["lon"]) == pytest.approx(180.0)
    assert row["lat"] == pytest.approx(10.0, abs=0.01)


def test_region_is_unknown_without_coordinates(spark):
    df = spark.createDataFrame([(None, None), (5.0, None), (5.0, 170.0), (5.0, -135.0)], "m double, d double")
    assert values(df, geo.region_label(F.col("m"), F.col("d"))) == [None, None, "west", "west"]


def test_arc_sines_of_arrays_have_the_bits_of_spark(spark):
    x = np.concatenate([np.random.default_rng(4).uniform(0, 1, 20_000), [0.0, 0.5, 0.975, 0.9749999046325684, 1.0]])
    rows = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i long, x double")
    expected = [r[0] for r in rows.orderBy("i").select(F.asin("x")).collect()]
    assert geo_arrays._arcsin(x).tolist() == expected
