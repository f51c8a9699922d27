"""The distances of :mod:`reviewlens.functions.geo` on arrays, for tasks that hold whole users."""

from __future__ import annotations

import math

import numpy as np

from reviewlens.functions.geo import FLATTENING, RADIUS_MILES

Places = tuple[np.ndarray, np.ndarray, np.ndarray]


def unit_vectors(latitude: np.ndarray, longitude: np.ndarray) -> Places:
    height = np.arctan(np.tan(np.radians(latitude)) * (1.0 - FLATTENING))
    turn = np.radians(longitude)
    return np.cos(height) * np.cos(turn), np.cos(height) * np.sin(turn), np.sin(height)


# The quotients and parts of pi that give the arc sine in the JVM's mathematics.
_ABOVE = (1.66666666666666657415e-01, -3.25565818622400915405e-01, 2.01212532134862925881e-01,
          -4.00555345006794114027e-02, 7.91534994289814532176e-04, 3.47933107596021167570e-05)
_BELOW = (1.0, -2.40339491173441421878e00, 2.02094576023350569471e00, -6.88283971605453293030e-01, 7.70381505559019352791e-02)
_QUARTER_PI = 7.85398163397448278999e-01
_HALF_PI, _HALF_PI_REST = 1.57079632679489655800e00, 6.12323399573676603587e-17
_NEAR_ONE = 0.974999904632568359375


def _arcsin(x: np.ndarray) -> np.ndarray:
    """Arc sine of numbers from 0 to 1 with the bits that Spark's has: clusterings whose rounds do not
    settle hang on the last bit of a distance."""

    def value(of: tuple[float, ...], t: np.ndarray) -> np.ndarray:
        found = np.full(t.shape, of[-1])
        for one in of[-2::-1]:
            found = one + t * found
        return found

    def quotient(t: np.ndarray) -> np.ndarray:
        return t * value(_ABOVE, t) / value(_BELOW, t)

    found = x + x * quotient(x * x)
    far = np.flatnonzero(x >= 0.5)
    if len(far):  # some 4,000 miles and more
        t = (1.0 - x[far]) * 0.5
        s, r = np.sqrt(t), quotient(t)
        high = (s.view(np.int64) & ~np.int64(0xFFFFFFFF)).view(np.float64)
        rest = (t - high * high) / np.where(s == 0.0, 1.0, s + high)
        middle = _QUARTER_PI - ((2.0 * s * r - (_HALF_PI_REST - 2.0 * rest)) - (_QUARTER_PI - 2.0 * high))
        end = _HALF_PI - (2.0 * (s + s * r) - _HALF_PI_REST)
        found[far] = np.where(x[far] >= _NEAR_ONE, end, middle)
    return found


def _halves(at: Places, i: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Squared sines of half the angles between places i and k."""
    squares = 0.0
    for axis in at:
        gap = axis[i] - axis[k]
        squares = squares + gap * gap
    return np.minimum(squares / 4.0, 1.0)


def _lengths(half: np.ndarray, sine_a: np.ndarray, sine_b: np.ndarray) -> np.ndarray:
    rest = np.maximum(1.0 - half, 1e-12)
    some = np.where(half == 0.0, 1.0, half)
    angle = _arcsin(np.sqrt(half)) * 2.0
    sine = np.sqrt(half * rest) * 2.0
    shrink = (angle - sine) * (sine_a + sine_b) ** 2 / (rest * 4.0)
    shrink += (angle + sine) * (sine_b - sine_a) ** 2 / (some * 4.0)
    return np.where(half == 0.0, 0.0, (angle - shrink * (FLATTENING / 2.0)) * RADIUS_MILES)


def miles(at: Places, i: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Miles between places i and k."""
    return _lengths(_halves(at, i, k), at[2][i], at[2][k])


def near(at: Places, i: np.ndarray, k: np.ndarray, radius_miles: float) -> np.ndarray:
    """Whether places i and k are within the radius, limit included; all but a thin ring is decided
    by the angle."""

    def half_at(angle: float) -> float:
        return math.sin(min(angle, math.pi) / 2.0) ** 2

    half = _halves(at, i, k)
    found = half < half_at(radius_miles / RADIUS_MILES * (1.0 - 1e-6))
    open_ = np.flatnonzero(~found & (half <= half_at(radius_miles / RADIUS_MILES * (1.0 + 1.01 * FLATTENING))))
    found[open_] = _lengths(half[open_], at[2][i[open_]], at[2][k[open_]]) <= radius_miles
    return found
