"""Coordinate helpers: great-circle distance (S10) and Java-style rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from occulink.functions.common import as_col

# fixed value: mean earth radius used by the distance rule, in km
EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1, lng1, lat2, lng2) -> Column:
    """Haversine distance in km, ``2 * atan2(sqrt(a), sqrt(1 - a))`` form."""
    lat1, lng1, lat2, lng2 = map(as_col, (lat1, lng1, lat2, lng2))
    d_lat = F.radians(lat2 - lat1)
    d_lng = F.radians(lng2 - lng1)
    half = lambda x: F.pow(F.sin(x / 2), 2)
    a = half(d_lat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(d_lng)
    return F.lit(EARTH_RADIUS_KM) * (2 * F.atan2(F.sqrt(a), F.sqrt(1 - a)))


def round_half_up(x) -> Column:
    """``Math.round``: nearest long, ties toward +infinity, NaN -> 0, values
    beyond the long range (infinities too) -> its ends.

    ``x - floor(x)`` is exact for doubles, so this matches the JDK also where
    ``floor(x + 0.5)`` would round wrongly (e.g. 0.49999999999999994).
    """
    x = as_col(x)
    fl = F.floor(x)
    rounded = F.when((x - fl >= 0.5) & (fl < F.lit((1 << 63) - 1)), fl + 1).otherwise(fl)
    return F.when(F.isnan(x), F.lit(0).cast("bigint")).otherwise(rounded)
