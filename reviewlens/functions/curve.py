"""Places along a space-filling curve, so that near places get near keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of each coordinate: steps of about 0.0003 degrees of longitude.
BITS = 20

# Shifts and masks that put a zero bit between the bits of a number.
_SPREAD = [
    (16, 0x0000FFFF0000FFFF),
    (8, 0x00FF00FF00FF00FF),
    (4, 0x0F0F0F0F0F0F0F0F),
    (2, 0x3333333333333333),
    (1, 0x5555555555555555),
]


def _step(value: Column, low: float, width: float) -> Column:
    """The coordinate's step, 0 to 2 ** BITS - 1; what lies outside counts as on the border."""
    step = F.floor((value - low) / width * (1 << BITS)).cast("long")
    return F.least(F.greatest(step, F.lit(0)), F.lit((1 << BITS) - 1))


def _spread(value: Column) -> Column:
    for shift, mask in _SPREAD:
        value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask))
    return value


def z_key(latitude: Column, longitude: Column) -> Column:
    """Key along the Z curve: the bits of both coordinates in turn. Null where either is null."""
    known = latitude.isNotNull() & longitude.isNotNull()
    y, x = _spread(_step(latitude, -90.0, 180.0)), _spread(_step(longitude, -180.0, 360.0))
    return F.when(known, F.shiftleft(y, 1).bitwiseOR(x))
