"""Great-circle distance as a native expression."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two distance formulas differ in radius and in pi.
ASIN_RADIUS_M = 6371393
ASIN_PI = 3.1415926
ATAN2_RADIUS_KM = 6371


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column, mode: str = "asin") -> Column:
    """Metres between two points given in degrees.

    ``asin`` subtracts after the change to radians, ``atan2`` before it; the last
    bit of the result, and so the sign of tiny accelerations, depends on that.
    """
    if mode == "asin":
        lat1, lon1, lat2, lon2 = (c * ASIN_PI / 180 for c in (lat1, lon1, lat2, lon2))
        half_lat, half_lon = F.abs(lat2 - lat1) / 2, F.abs(lon2 - lon1) / 2
        a = F.pow(F.sin(half_lat), 2) + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin(half_lon), 2)
        return F.asin(F.sqrt(a)) * 2 * ASIN_RADIUS_M
    if mode == "atan2":
        half_lat = (lat2 - lat1) * math.pi / 180.0 / 2
        half_lon = (lon2 - lon1) * math.pi / 180.0 / 2
        cosines = F.cos(lat1 * math.pi / 180.0) * F.cos(lat2 * math.pi / 180.0)
        a = F.sin(half_lat) * F.sin(half_lat) + cosines * F.sin(half_lon) * F.sin(half_lon)
        return F.atan2(F.sqrt(a), F.sqrt(1 - a)) * 2 * ATAN2_RADIUS_KM * 1000
    raise ValueError(f"unknown mode: {mode}")

