"""Coordinates: validity, projection to metres, distances."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from meshtally.constants import EARTH_RADIUS_M, LAT_BOX, LON_BOX, METRIC_CRS

# GRS80 ellipsoid and the published parameters of the Brazilian polyconic grid.
_A = 6_378_137.0
_F = 1 / 298.257222101
_E2 = _F * (2 - _F)
_LON0, _FALSE_EAST, _FALSE_NORTH = -54.0, 5_000_000.0, 10_000_000.0


def valid_point(lat: Column, lon: Column) -> Column:
    """True only for a real coordinate inside the country box (zero is a sentinel)."""
    return F.coalesce(
        lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)
        & (F.abs(lat) >= 0.001) & (F.abs(lon) >= 0.001)
        & lat.between(*LAT_BOX) & lon.between(*LON_BOX), F.lit(False))


def clean_point(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Both coordinates, or neither."""
    ok = valid_point(lat, lon)
    return F.when(ok, lat), F.when(ok, lon)


def polyconic(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Easting and northing in metres: the American polyconic series on GRS80."""
    phi = F.radians(lat)
    dlon = F.radians(lon - F.lit(_LON0))
    e4, e6 = _E2 ** 2, _E2 ** 3
    meridian = F.lit(_A) * (
        phi * F.lit(1 - _E2 / 4 - 3 * e4 / 64 - 5 * e6 / 256)
        - F.sin(phi * 2) * F.lit(3 * _E2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024)
        + F.sin(phi * 4) * F.lit(15 * e4 / 256 + 45 * e6 / 1024)
        - F.sin(phi * 6) * F.lit(35 * e6 / 3072))
    # The cotangent has no value on the equator, where the series degenerates.
    safe = F.when(phi == 0, F.lit(1.0)).otherwise(phi)
    normal = F.lit(_A) / F.sqrt(1 - F.lit(_E2) * F.sin(safe) * F.sin(safe))
    arc = dlon * F.sin(safe)
    reach = normal * F.cos(safe) / F.sin(safe)
    east = F.when(phi == 0, F.lit(_A) * dlon).otherwise(reach * F.sin(arc))
    north = F.when(phi == 0, F.lit(0.0)).otherwise(meridian + reach * (1 - F.cos(arc)))
    return east + F.lit(_FALSE_EAST), north + F.lit(_FALSE_NORTH)


def local_metres(lat: Column, lon: Column, mean_lat: Column) -> tuple[Column, Column]:
    """Flat metres around a municipality: longitude shrinks with its mean latitude."""
    return (F.radians(lon) * F.lit(EARTH_RADIUS_M) * F.cos(F.radians(mean_lat)),
            F.radians(lat) * F.lit(EARTH_RADIUS_M))


def great_circle(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance in metres."""
    a, b = F.radians(lat1), F.radians(lat2)
    half_lat, half_lon = (b - a) / 2, (F.radians(lon2) - F.radians(lon1)) / 2
    h = F.sin(half_lat) * F.sin(half_lat) + F.cos(a) * F.cos(b) * F.sin(half_lon) * F.sin(half_lon)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def require_metric(crs: str, where: str) -> None:
    """Distances must be taken in metres: a degree is not a unit of length."""
    if str(crs) != METRIC_CRS:
        raise ValueError(f"{where}: distances are taken in {METRIC_CRS}, got {crs}")


def meridian_arc(lat_deg: float) -> float:
    """Closed check value for tests: northing of a point on the central meridian."""
    phi, e4, e6 = math.radians(lat_deg), _E2 ** 2, _E2 ** 3
    return _A * (phi * (1 - _E2 / 4 - 3 * e4 / 64 - 5 * e6 / 256)
                 - math.sin(2 * phi) * (3 * _E2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024)
                 + math.sin(4 * phi) * (15 * e4 / 256 + 45 * e6 / 1024)
                 - math.sin(6 * phi) * (35 * e6 / 3072))
