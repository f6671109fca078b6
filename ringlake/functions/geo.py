"""Column expressions on coordinates in degrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Earth radii in metres (rings; ring signals) and metres a degree.
RADIUS_M, SIGNAL_RADIUS_M, DEGREE_M = 6371000.0, 6371008.8, 111320.0


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column, radius: float = RADIUS_M) -> Column:
    """Great-circle metres; the root is held to 1 so that antipodes stay defined."""
    half = lambda a, b: F.sin((F.radians(b) - F.radians(a)) / 2.0)
    h = half(lat1, lat2) * half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2) * half(lon1, lon2)
    return 2.0 * radius * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def east(lon: Column, lon0: Column, lat0: Column, per_degree: float = DEGREE_M) -> Column:
    """Metres east of ``lon0`` on the plane tangent at ``lat0``."""
    return (lon - lon0) * F.cos(F.radians(lat0)) * per_degree


def north(lat: Column, lat0: Column, per_degree: float = DEGREE_M) -> Column:
    return (lat - lat0) * per_degree


def turn_degrees(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Angle between two legs; null where either has no length."""
    size = F.sqrt(ax * ax + ay * ay) * F.sqrt(bx * bx + by * by)
    return F.when(size > 0, F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (ax * bx + ay * by) / size)))))


def along(px: Column, py: Column, qx: Column, qy: Column) -> Column:
    """Where the foot of a point (p) falls on a leg from the origin to (q), held to 0..1; 0 on a leg without length."""
    size = qx * qx + qy * qy
    return F.when(size > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (px * qx + py * qy) / size))).otherwise(F.lit(0.0))


def lerp(a: Column, b: Column, t: Column) -> Column:
    return a + (b - a) * t


def fitted(v: Column, low: Column, high: Column, size: float, pad: float, flip: bool = False) -> Column:
    """Coordinate on a canvas of ``size`` with ``pad`` around; flipped for the vertical axis."""
    u = (v - low) / F.nullif(high - low, F.lit(0.0)) * (size - 2 * pad)
    return (size - pad - u) if flip else (pad + u)
