"""Distances, coordinate checks and rounding. NaN is neither inside nor outside of anything."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed

EARTH_KM = 6371.0


def _haversine_a(lat1, lon1, lat2, lon2) -> Column:
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    s, t = F.sin(dlat / 2), F.sin(dlon / 2)
    return s * s + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * t * t


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    a = _haversine_a(lat1, lon1, lat2, lon2)
    return EARTH_KM * 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def haversine_asin_km(lat1, lon1, lat2, lon2) -> Column:
    """The form that the gazetteer's distance gate uses; it may differ in the last digit."""
    return 2 * EARTH_KM * F.asin(F.sqrt(_haversine_a(lat1, lon1, lat2, lon2)))


def less(a, b) -> Column:
    """a < b as floating point has it: false for NaN."""
    a, b = (x if isinstance(x, Column) else F.lit(float(x)) for x in (a, b))
    return ~F.isnan(a) & ~F.isnan(b) & (a < b)


def proximity(km: Column) -> Column:
    """0 to 100 by distance."""
    out = F.lit(0)
    for limit, score in ((500, 15), (200, 40), (75, 65), (25, 85), (5, 100)):
        out = F.when(less(km, limit), score).otherwise(out)
    return out


def round_coord(v: Column) -> Column:
    """Five decimals, half away from zero; 0 for NaN and infinities."""
    bad = F.isnan(v) | (F.abs(v) == float("inf"))
    scaled = v * 100000.0
    away = F.signum(scaled) * F.floor(F.abs(scaled) + 0.5)
    return F.when(bad, 0.0).otherwise((away / 100000.0).cast("double"))


def null_island(lat: Column, lon: Column) -> Column:
    return less(F.abs(lat), 0.01) & less(F.abs(lon), 0.01)


def out_of_range(lat: Column, lon: Column) -> Column:
    return less(lat, -90) | less(F.lit(90.0), lat) | less(lon, -180) | less(F.lit(180.0), lon)


def in_country_box(country: Column, lat: Column, lon: Column) -> Column:
    """True for countries without a box."""

    def inside(box):
        south, north, west, east = box
        ok = ~less(lat, south) & ~less(F.lit(north), lat)
        if west > east:  # over the antimeridian
            return ok & (~less(lon, west) | ~less(F.lit(east), lon))
        return ok & ~less(lon, west) & ~less(F.lit(east), lon)

    return reduce(lambda rest, c: F.when(country == c, inside(fixed.BOXES[c])).otherwise(rest), fixed.BOXES, F.lit(True))


def is_country_centroid(country: Column, lat: Column, lon: Column) -> Column:
    def near(points):
        close = [less(F.abs(lat - y), fixed.CENTROID_TOLERANCE) & less(F.abs(lon - x), fixed.CENTROID_TOLERANCE) for y, x in points]
        return reduce(lambda a, b: a | b, close)

    return reduce(lambda rest, c: F.when(country == c, near(fixed.CENTROIDS[c])).otherwise(rest), fixed.CENTROIDS, F.lit(False))
