"""Distances on the sphere and distance units."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, functions as F

EARTH_RADIUS_M = 6371008.7714

# Metres per unit.
UNITS = {"mm": 0.001, "cm": 0.01, "m": 1.0, "km": 1000.0, "in": 0.0254, "ft": 0.3048, "yd": 0.9144, "mi": 1609.344, "nmi": 1852.0}


def parse_distance(text: str) -> float:
    """``12km`` to metres; a plain number means metres."""
    m = re.fullmatch(r"\s*([0-9]+(?:\.[0-9]+)?)\s*([a-z]*)\s*", text)
    if not m or (m.group(2) or "m") not in UNITS:
        raise ValueError(f"not a distance: {text!r}")
    return float(m.group(1)) * UNITS[m.group(2) or "m"]


def haversine_m(lat: Column, lon: Column, lat0: float, lon0: float) -> Column:
    """Great-circle distance in metres from a fixed point."""
    dlat = F.radians(lat - F.lit(float(lat0)))
    dlon = F.radians(lon - F.lit(float(lon0)))
    a = F.pow(F.sin(dlat / 2), 2) + F.lit(math.cos(math.radians(lat0))) * F.cos(F.radians(lat)) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def longitudes(lat0: float, lon0: float, metres: float) -> list[tuple[float, float]] | None:
    """Ranges of longitude within -180 and 180 that hold the circle; None where it holds a pole.

    A circle over the date line gives two ranges.
    """
    radius = metres / EARTH_RADIUS_M
    if abs(math.radians(lat0)) + radius >= math.pi / 2:
        return None
    half = math.degrees(math.asin(min(1.0, math.sin(radius) / math.cos(math.radians(lat0))))) + 1e-6
    west, east = lon0 - half, lon0 + half
    if west < -180:
        return [(west + 360, 180.0), (-180.0, east)]
    if east > 180:
        return [(west, 180.0), (-180.0, east - 360)]
    return [(west, east)]


def within(point: Column, lat0: float, lon0: float, metres: float) -> Column:
    """Distance test; the box around the circle first, as its bounds can prune row groups.

    The box counts longitudes from -180 to 180; a point that is given beyond them is tested by its
    distance alone.
    """
    lat, lon = point["lat"], point["lon"]
    band = math.degrees(metres / EARTH_RADIUS_M) + 1e-6
    box = lat.between(lat0 - band, lat0 + band)
    ranges = longitudes(lat0, lon0, metres)
    if ranges is not None:
        inside = (lon < -180.0) | (lon > 180.0)
        for west, east in ranges:
            inside = inside | lon.between(west, east)
        box = box & inside
    return box & (haversine_m(lat, lon, lat0, lon0) <= F.lit(float(metres)))
