"""Geography on plain columns: great-circle distance and UTM, without UDFs."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS = 6_371_000.0


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return 2 * EARTH_RADIUS * F.atan2(F.sqrt(a), F.sqrt(1 - a))


# WGS84 and the transverse Mercator series in the third flattening, to the fourth order.
_A, _F, _K0 = 6_378_137.0, 1 / 298.257223563, 0.9996
_N = _F / (2 - _F)
_RECTIFYING = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
_BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)
_DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35,
    4279 * _N**4 / 630,
)


def utm_zone(lon: Column) -> Column:
    return (F.floor((lon + 180) / 6) + 1).cast("int")


def _central(zone: Column | int) -> Column:
    zone = F.lit(zone) if isinstance(zone, int) else zone
    return F.radians((zone - 1) * 6 - 180 + 3)


def utm_forward(lat: Column, lon: Column, zone: Column | int, north: bool = True) -> tuple[Column, Column]:
    """Easting and northing in metres."""
    phi, lam = F.radians(lat), F.radians(lon) - _central(zone)
    e = 2 * math.sqrt(_N) / (1 + _N)
    t = F.sinh(F.atanh(F.sin(phi)) - e * F.atanh(e * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east, up = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        east += a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        up += a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return 500_000.0 + _K0 * _RECTIFYING * east, (0.0 if north else 10_000_000.0) + _K0 * _RECTIFYING * up


def utm_inverse(easting: Column, northing: Column, zone: Column | int, north: bool = True) -> tuple[Column, Column]:
    """Latitude and longitude in degrees."""
    xi, eta = (northing - (0.0 if north else 10_000_000.0)) / (_K0 * _RECTIFYING), (easting - 500_000.0) / (_K0 * _RECTIFYING)
    x, y = xi, eta
    for j, b in enumerate(_BETA, 1):
        x -= b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        y -= b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(x) / F.cosh(y))
    phi = chi
    for j, d in enumerate(_DELTA, 1):
        phi += d * F.sin(2 * j * chi)
    return F.degrees(phi), F.degrees(_central(zone) + F.atan2(F.sinh(y), F.cos(x)))
