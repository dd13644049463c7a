"""Great-circle distance as a native column expression."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EARTH_RADIUS_KM = 6371.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Haversine distance in km; any null input gives null.

    ``a`` is clamped to 1 before ``asin(sqrt(a))``: rounding can push it just
    above 1 for antipodal points, where ``asin`` would return NaN.
    """
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dlat = p2 - p1
    dlon = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    # least() skips nulls and orders NaN above 1, so alone it would turn a
    # null or NaN input into the antipodal distance: pass those through.
    a = F.when(a.isNull() | F.isnan(a), a).otherwise(F.least(F.lit(1.0), a))
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))
