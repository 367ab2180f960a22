"""WGS84 to UTM (by Krueger's series to the fourth order) and to Web Mercator and back, as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: WGS84 and UTM.
AXIS, FLATTENING, SCALE, EAST, SOUTH = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0, 10000000.0
N = FLATTENING / (2 - FLATTENING)
RADIUS = AXIS / (1 + N) * (1 + N**2 / 4 + N**4 / 64)
ECCENTRICITY = 2 * math.sqrt(N) / (1 + N)
#: The series' coefficients.
ALPHA = (N / 2 - 2 * N**2 / 3 + 5 * N**3 / 16 + 41 * N**4 / 180, 13 * N**2 / 48 - 3 * N**3 / 5 + 557 * N**4 / 1440, 61 * N**3 / 240 - 103 * N**4 / 140, 49561 * N**4 / 161280)
BETA = (N / 2 - 2 * N**2 / 3 + 37 * N**3 / 96 - N**4 / 360, N**2 / 48 + N**3 / 15 - 437 * N**4 / 1440, 17 * N**3 / 480 - 37 * N**4 / 840, 4397 * N**4 / 161280)
DELTA = (2 * N - 2 * N**2 / 3 - 2 * N**3 + 116 * N**4 / 45, 7 * N**2 / 3 - 8 * N**3 / 5 - 227 * N**4 / 45, 56 * N**3 / 15 - 136 * N**4 / 35, 4279 * N**4 / 630)


def zone_of(epsg: int) -> tuple[float, float]:
    """Central meridian in degrees and false northing of 32601-32660 and 32701-32760; other systems are refused."""
    if not (32601 <= epsg <= 32660 or 32701 <= epsg <= 32760):
        raise ValueError(f"EPSG:{epsg} is neither WGS84 (4326), Web Mercator (3857) nor a UTM zone on WGS84")
    return 6.0 * (epsg % 100) - 183.0, SOUTH if epsg >= 32700 else 0.0


def series(first: Column, terms: tuple[float, ...], f: callable) -> Column:
    total = first
    for j, k in enumerate(terms, 1):
        total = total + k * f(2 * j)
    return total


def to_utm(lon: Column, lat: Column, epsg: int) -> tuple[Column, Column]:
    """Easting and northing in metres."""
    meridian, north = zone_of(epsg)
    sine, away = F.sin(F.radians(lat)), F.radians(lon - meridian)
    t = F.sinh(F.atanh(sine) - ECCENTRICITY * F.atanh(ECCENTRICITY * sine))
    xi, eta = F.atan2(t, F.cos(away)), F.atanh(F.sin(away) / F.sqrt(1 + t * t))
    x = series(eta, ALPHA, lambda m: F.cos(m * xi) * F.sinh(m * eta))
    y = series(xi, ALPHA, lambda m: F.sin(m * xi) * F.cosh(m * eta))
    return EAST + SCALE * RADIUS * x, north + SCALE * RADIUS * y


def from_utm(x: Column, y: Column, epsg: int) -> tuple[Column, Column]:
    """Longitude and latitude in degrees."""
    meridian, north = zone_of(epsg)
    xi, eta = (y - north) / (SCALE * RADIUS), (x - EAST) / (SCALE * RADIUS)
    xi0 = series(xi, tuple(-b for b in BETA), lambda m: F.sin(m * xi) * F.cosh(m * eta))
    eta0 = series(eta, tuple(-b for b in BETA), lambda m: F.cos(m * xi) * F.sinh(m * eta))
    chi = F.asin(F.sin(xi0) / F.cosh(eta0))
    lat = series(chi, DELTA, lambda m: F.sin(m * chi))
    return meridian + F.degrees(F.atan(F.sinh(eta0) / F.cos(xi0))), F.degrees(lat)


def to_utm_number(lon: float, lat: float, epsg: int) -> tuple[float, float]:
    """to_utm of one point, for the corners of a grid."""
    meridian, north = zone_of(epsg)
    sine, away = math.sin(math.radians(lat)), math.radians(lon - meridian)
    t = math.sinh(math.atanh(sine) - ECCENTRICITY * math.atanh(ECCENTRICITY * sine))
    xi, eta = math.atan2(t, math.cos(away)), math.atanh(math.sin(away) / math.hypot(1, t))
    x = eta + sum(a * math.cos(2 * j * xi) * math.sinh(2 * j * eta) for j, a in enumerate(ALPHA, 1))
    y = xi + sum(a * math.sin(2 * j * xi) * math.cosh(2 * j * eta) for j, a in enumerate(ALPHA, 1))
    return EAST + SCALE * RADIUS * x, north + SCALE * RADIUS * y


def to_system_number(lon: float, lat: float, epsg: int) -> tuple[float, float]:
    """One point in a system: UTM on WGS84, Web Mercator (3857), or degrees as they are (4326)."""
    if epsg == 4326:
        return lon, lat
    if epsg == 3857:
        return AXIS * math.radians(lon), AXIS * math.asinh(math.tan(math.radians(lat)))
    return to_utm_number(lon, lat, epsg)


def from_system(x: Column, y: Column, epsg: int) -> tuple[Column, Column]:
    """Longitude and latitude in degrees of places in a system."""
    if epsg == 4326:
        return x, y
    if epsg == 3857:
        return F.degrees(x / AXIS), F.degrees(F.atan(F.sinh(y / AXIS)))
    return from_utm(x, y, epsg)
