"""Trip distances in kilometres as column arithmetic (degrees in)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: earth radius in kilometres.
EARTH_RADIUS_KM = 6372.8


def _arc(a: Column) -> Column:
    """Radius times the central angle; NULL where ``a`` lies outside 0..1 or is not a number.

    ``a`` is bound once, as an element of an array, because the formula names it several times.
    """

    def angle(x: Column) -> Column:
        return F.when(x.between(0, 1), 2 * EARTH_RADIUS_KM * F.atan2(F.sqrt(x), F.sqrt(1 - x)))

    return F.transform(F.array(a), angle)[0]


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_phi = (phi2 - phi1) / 2
    half_lambda = F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(half_phi), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(half_lambda), 2)
    # rounding can lift antipodes just above 1
    return _arc(F.round(a, 15))


def legacy_trip_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """The distance an older fare model was trained on, kept so that its features can be rebuilt.

    It is not a distance on a sphere: each difference is taken between latitude and longitude
    of one point, converted to radians twice, and the second term has no sine. Where the
    formula has no real value the result is NULL.
    """
    phi1, lam1, phi2, lam2 = (F.radians(c) for c in (lat1, lon1, lat2, lon2))
    first = F.sin(F.radians(phi1 - lam1) / 2)
    second = F.radians(phi2 - lam2) / 2
    return _arc(first * first + F.cos(phi1) * F.cos(lam1) * second * second)
