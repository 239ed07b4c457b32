"""Closed-form transforms between EPSG:4326, 3857 and 26913, as column expressions on points."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The WGS 84 / GRS 80 ellipsoid and UTM zone 13 north.
RADIUS = 6378137.0
FLATTENING = 1 / 298.257222101
UTM_SCALE, UTM_EAST, CENTRAL_MERIDIAN = 0.9996, 500000.0, -105.0

_N = FLATTENING / (2 - FLATTENING)
_A = RADIUS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_E = math.sqrt(FLATTENING * (2 - FLATTENING))
# The third-order Krueger series.
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)


def to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    return F.radians(lon) * RADIUS, F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * RADIUS


def from_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    return F.degrees(x / RADIUS), F.degrees(2 * F.atan(F.exp(y / RADIUS)) - math.pi / 2)


def _atanh(x: Column) -> Column:
    return F.log((1 + x) / (1 - x)) / 2


def to_utm13(lon: Column, lat: Column) -> tuple[Column, Column]:
    phi, lam = F.radians(lat), F.radians(lon - CENTRAL_MERIDIAN)
    t = F.sinh(_atanh(F.sin(phi)) - _E * _atanh(_E * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), _atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return UTM_EAST + UTM_SCALE * _A * x, UTM_SCALE * _A * y


def from_utm13(east: Column, north: Column) -> tuple[Column, Column]:
    xi, eta = north / (UTM_SCALE * _A), (east - UTM_EAST) / (UTM_SCALE * _A)
    u, v = xi, eta
    for j, b in enumerate(_BETA, 1):
        u = u - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        v = v - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(u) / F.cosh(v))
    lat = chi
    for j, d in enumerate(_DELTA, 1):
        lat = lat + d * F.sin(2 * j * chi)
    return CENTRAL_MERIDIAN + F.degrees(F.atan2(F.sinh(v), F.cos(u))), F.degrees(lat)


_TO_DEGREES = {4326: lambda x, y: (x, y), 3857: from_mercator, 26913: from_utm13}
_FROM_DEGREES = {4326: lambda x, y: (x, y), 3857: to_mercator, 26913: to_utm13}


def reproject(x: Column, y: Column, source: int, target: int) -> tuple[Column, Column]:
    """(x, y) of a point in another of the three systems."""
    if unknown := {source, target} - set(_TO_DEGREES):
        raise ValueError(f"unknown EPSG codes: {sorted(unknown)}")
    return (x, y) if source == target else _FROM_DEGREES[target](*_TO_DEGREES[source](x, y))


def reproject_ring(ring: Column, source: int, target: int) -> Column:
    """A ring's points in another system, vertex by vertex."""
    def one(p: Column) -> Column:
        x, y = reproject(p["x"], p["y"], source, target)
        return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))

    return F.transform(ring, one)


def reproject_bounds(west: Column, south: Column, east: Column, north: Column, source: int, target: int, steps: int = 21) -> Column:
    """The box around a box's outline in another system, each side with ``steps`` points between its ends.

    Between degrees and Mercator each axis goes by itself and keeps its order, so two corners are exact.
    """
    if {source, target} <= {4326, 3857}:
        (x0, y0), (x1, y1) = reproject(west, south, source, target), reproject(east, north, source, target)
        return F.struct(*[v.cast("double").alias(n) for n, v in (
            ("west", F.least(x0, x1)), ("south", F.least(y0, y1)), ("east", F.greatest(x0, x1)), ("north", F.greatest(y0, y1)))])
    along = F.transform(F.sequence(F.lit(0), F.lit(steps + 1)), lambda i: i / F.lit(float(steps + 1)))
    sides = F.concat(
        F.transform(along, lambda t: F.struct((west + (east - west) * t).alias("x"), south.alias("y"))),
        F.transform(along, lambda t: F.struct((west + (east - west) * t).alias("x"), north.alias("y"))),
        F.transform(along, lambda t: F.struct(west.alias("x"), (south + (north - south) * t).alias("y"))),
        F.transform(along, lambda t: F.struct(east.alias("x"), (south + (north - south) * t).alias("y"))),
    )
    ring = reproject_ring(sides, source, target)
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("west"), F.array_min(ys).alias("south"), F.array_max(xs).alias("east"), F.array_max(ys).alias("north"))
