"""Great-circle distance as a Column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in kilometres used for route distances.
EARTH_RADIUS_KM = 6371.0


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def great_circle_km(lat1, lon1, lat2, lon2, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Spherical law of cosines distance in km between two (lat, lon) points in degrees.

    The cosine argument is clamped to [-1, 1] (rounding can push it just past 1 and give
    NaN) and equal endpoints give exactly 0. Any null coordinate gives null.
    """
    la1, lo1, la2, lo2 = (F.radians(_col(c)) for c in (lat1, lon1, lat2, lon2))
    cosine = F.sin(la1) * F.sin(la2) + F.cos(la1) * F.cos(la2) * F.cos(lo2 - lo1)
    clamped = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cosine))
    same = (_col(lat1) == _col(lat2)) & (_col(lon1) == _col(lon2))
    # least/greatest skip nulls, so a null coordinate must be caught before the clamp
    return (F.when(same, F.lit(0.0))
            .when(cosine.isNotNull(), F.acos(clamped) * F.lit(radius_km)))
