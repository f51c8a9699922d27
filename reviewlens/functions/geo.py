"""Distances and directions on the earth as native column expressions.

Lambert's ellipsoidal correction of the great-circle angle, on reduced latitudes. It is closed
form and stays within centimetres of the iterative geodesic at city distances. Since
``sin P cos Q`` and ``cos P sin Q`` are half the sum and half the difference of the sines of the
two latitudes, everything follows from those sines and the squared sine of half the angle.

Places that meet many others are turned once into unit vectors, so that a pair costs a few
products; a filter against a fixed point uses the half-angle form, which repeats less.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS-84 ellipsoid and the international mile.
EQUATOR_METRES = 6378137.0
FLATTENING = 1.0 / 298.257223563
METRES_PER_MILE = 1609.344
RADIUS_MILES = EQUATOR_METRES / METRES_PER_MILE

# Shortest and longest length in miles of a degree of arc on that ellipsoid.
MIN_MILES_PER_DEGREE = 68.70
MAX_MILES_PER_DEGREE = 69.41
# No two places are further apart.
HALF_WAY_ROUND_MILES = 180.0 * MAX_MILES_PER_DEGREE

Vector = tuple[Column, Column, Column]


def _reduced(latitude: Column) -> Column:
    return F.atan(F.tan(F.radians(latitude)) * (1.0 - FLATTENING))


def unit_vector(latitude: Column, longitude: Column) -> Vector:
    """Unit vector of a place, taken at its reduced latitude."""
    height, turn = _reduced(latitude), F.radians(longitude)
    return F.cos(height) * F.cos(turn), F.cos(height) * F.sin(turn), F.sin(height)


def vector_columns(prefix: str = "v") -> Vector:
    return F.col(f"{prefix}x"), F.col(f"{prefix}y"), F.col(f"{prefix}z")


def with_vector(df, prefix: str = "v", latitude: str = "latitude", longitude: str = "longitude"):
    """Add the unit vector of a place as three plain columns."""
    x, y, z = unit_vector(F.col(latitude), F.col(longitude))
    return df.withColumns({f"{prefix}x": x, f"{prefix}y": y, f"{prefix}z": z})


def _length(half: Column, sine_a: Column, sine_b: Column) -> Column:
    """Miles from the squared sine of half the angle and the sines of the reduced latitudes."""
    rest = F.greatest(F.lit(1.0) - half, F.lit(1e-12))
    angle = F.asin(F.sqrt(half)) * 2.0
    sine = F.sqrt(half * rest) * 2.0
    shrink = (angle - sine) * F.pow(sine_a + sine_b, F.lit(2.0)) / (rest * 4.0)
    shrink += (angle + sine) * F.pow(sine_b - sine_a, F.lit(2.0)) / (half * 4.0)
    length = (angle - shrink * (FLATTENING / 2.0)) * RADIUS_MILES
    return F.when(half == 0.0, F.lit(0.0)).otherwise(length)


def _half_between(a: Vector, b: Vector) -> Column:
    dx, dy, dz = (p - q for p, q in zip(a, b))
    return F.least((dx * dx + dy * dy + dz * dz) / 4.0, F.lit(1.0))


def miles_between(a: Vector, b: Vector) -> Column:
    """Length in miles of the shortest path between two places given as unit vectors."""
    return _length(_half_between(a, b), a[2], b[2])


def _half_of(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    high_a, high_b = _reduced(lat_a), _reduced(lat_b)
    two = F.lit(2.0)
    turn = F.pow(F.sin(F.radians(lon_b - lon_a) / 2.0), two)
    half = F.pow(F.sin((high_b - high_a) / 2.0), two) + F.cos(high_a) * F.cos(high_b) * turn
    return F.least(half, F.lit(1.0))


def miles(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Geodesic miles between two pairs of latitude and longitude in degrees."""
    sines = F.sin(_reduced(lat_a)), F.sin(_reduced(lat_b))
    return _length(_half_of(lat_a, lon_a, lat_b, lon_b), *sines)


def _near(half: Column, exact: Column, radius_miles: float, inclusive: bool) -> Column:
    """Whether ``exact`` is within the radius, deciding all but a thin ring by ``half`` alone.

    A path is never longer than the angle times the equator's radius and shorter by one
    flattening at most.
    """

    def half_at(angle: float) -> float:
        return math.sin(min(angle, math.pi) / 2.0) ** 2

    surely = half_at(radius_miles / RADIUS_MILES * (1.0 - 1e-6))
    perhaps = half_at(radius_miles / RADIUS_MILES * (1.0 + 1.01 * FLATTENING))
    close = exact <= radius_miles if inclusive else exact < radius_miles
    return (half < surely) | ((half <= perhaps) & close)


def near_between(a: Vector, b: Vector, radius_miles: float, inclusive: bool = True) -> Column:
    """Whether two places given as unit vectors are within the radius of each other."""
    return _near(_half_between(a, b), miles_between(a, b), radius_miles, inclusive)


def half_height_degrees(radius_miles: float) -> float:
    return radius_miles / MIN_MILES_PER_DEGREE


def box_around(
    latitude: Column, longitude: Column, center: tuple[float, float], radius_miles: float
) -> Column:
    """Range test on literals that keeps every place within the radius, fit for scan pushdown."""
    lat, lon = center
    high = half_height_degrees(radius_miles)
    box = latitude.between(lat - high, lat + high)
    if abs(lat) + high >= 90.0:
        return box  # a pole is inside: every longitude can be in reach
    wide = math.degrees(math.asin(math.sin(math.radians(high)) / math.cos(math.radians(lat))))
    wide += 1e-9
    low, top = lon - wide, lon + wide
    sides = longitude.between(low, top)
    if low < -180.0:
        sides = sides | (longitude >= low + 360.0)
    if top > 180.0:
        sides = sides | (longitude <= top - 360.0)
    return box & sides


def within_miles(
    latitude: Column,
    longitude: Column,
    center: tuple[float, float],
    radius_miles: float,
    inclusive: bool = True,
) -> Column:
    """Whether a place lies within the radius of a given point: box first, then exact miles."""
    ends = latitude, longitude, F.lit(float(center[0])), F.lit(float(center[1]))
    near = _near(_half_of(*ends), miles(*ends), radius_miles, inclusive)
    return box_around(latitude, longitude, center, radius_miles) & near


def bearing_degrees(
    from_lat: Column, from_lon: Column, to_lat: Column, to_lon: Column
) -> Column:
    """Angle of the displacement, 0 along growing latitude and 90 along growing longitude."""
    return F.degrees(F.atan2(to_lon - from_lon, to_lat - from_lat))


# Labels per quarter turn as the published region files carry them, and the
# labels a compass gives. Keys are the angle ranges (-45,45], (45,135], the half turn, (-135,-45].
LITERAL_LABELS = {"ahead": "east", "right": "north", "behind": "west", "left": "south"}
COMPASS_LABELS = {"ahead": "north", "right": "east", "behind": "south", "left": "west"}
CENTRAL_MILES = 3.0


def region_label(distance: Column, degree: Column, corrected: bool = False) -> Column:
    """Name of the quarter of a city a place lies in, ``central`` within three miles, null without
    coordinates."""
    names = COMPASS_LABELS if corrected else LITERAL_LABELS
    return (
        F.when(distance <= CENTRAL_MILES, "central")
        .when((degree > -45) & (degree <= 45), names["ahead"])
        .when((degree > 45) & (degree <= 135), names["right"])
        .when((degree > -135) & (degree <= -45), names["left"])
        .when((degree > 135) | (degree <= -135), names["behind"])
    )


def spherical_center(latitude: Column, longitude: Column, weight: Column) -> tuple[Column, Column]:
    """Aggregates giving the latitude and longitude of the weighted mean direction of places."""
    lat, lon = F.radians(latitude), F.radians(longitude)
    size = F.sum(weight)
    x = F.sum(weight * F.cos(lat) * F.cos(lon)) / size
    y = F.sum(weight * F.cos(lat) * F.sin(lon)) / size
    z = F.sum(weight * F.sin(lat)) / size
    return F.degrees(F.atan2(z, F.sqrt(x * x + y * y))), F.degrees(F.atan2(y, x))
