"""Planar geometry as column expressions on rings, arrays of struct<x, y>, and polygons, arrays of rings."""

from __future__ import annotations

import math

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """The closed ring of a box."""
    return F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1), point(x0, y0))


def closed(ring: Column) -> Column:
    """ring with its first point again at the end, unless it is there."""
    return F.when(F.element_at(ring, 1) == F.element_at(ring, -1), ring).otherwise(F.concat(ring, F.slice(ring, 1, 1)))


def signed_area(ring: Column) -> Column:
    """The shoelace area of a closed ring, counter-clockwise positive."""
    step = F.zip_with(
        F.slice(ring, F.lit(1), F.size(ring) - 1), F.slice(ring, F.lit(2), F.size(ring) - 1),
        lambda p, q: p["x"] * q["y"] - q["x"] * p["y"],
    )
    return F.aggregate(step, F.lit(0.0), lambda s, x: s + x) / 2


def polygon_area(rings: Column) -> Column:
    """The area of a polygon: its outer ring without the holes that follow."""
    holes = F.aggregate(F.slice(rings, F.lit(2), F.size(rings)), F.lit(0.0), lambda s, r: s + F.abs(signed_area(r)))
    return F.abs(signed_area(F.element_at(rings, 1))) - holes


def centroid(ring: Column) -> Column:
    """The centre of mass of a closed ring with an area."""
    pairs = F.zip_with(
        F.slice(ring, F.lit(1), F.size(ring) - 1), F.slice(ring, F.lit(2), F.size(ring) - 1),
        lambda p, q: F.struct((p["x"] + q["x"]).alias("x"), (p["y"] + q["y"]).alias("y"), (p["x"] * q["y"] - q["x"] * p["y"]).alias("w")),
    )
    total = lambda k: F.aggregate(pairs, F.lit(0.0), lambda s, t: s + t[k] * t["w"])
    return point(total("x") / (6 * signed_area(ring)), total("y") / (6 * signed_area(ring)))


def rotated(ring: Column, degrees: Column, centre: Column) -> Column:
    """ring turned counter-clockwise about a point."""
    c, s = F.cos(F.radians(degrees)), F.sin(F.radians(degrees))
    return F.transform(ring, lambda p: point(
        centre["x"] + (p["x"] - centre["x"]) * c - (p["y"] - centre["y"]) * s,
        centre["y"] + (p["x"] - centre["x"]) * s + (p["y"] - centre["y"]) * c,
    ))


def axis_snapped(ring: Column, tolerance_degrees: float) -> Column:
    """A closed ring whose edges within the angle of an axis run along it.

    A fold: each point is compared with the one before it as already moved, level edges before upright ones. Points
    that fall together become one; the ring is closed again. A ring of under 4 points stays.
    """
    slope = math.tan(math.radians(tolerance_degrees))

    def step(done: Column, p: Column) -> Column:
        last = F.element_at(done, -1)
        dx, dy = F.abs(p["x"] - last["x"]), F.abs(p["y"] - last["y"])
        level = (dx > 0) & (dy <= dx * slope)
        upright = ~level & (dy > 0) & (dx <= dy * slope)
        moved = point(F.when(upright, last["x"]).otherwise(p["x"]), F.when(level, last["y"]).otherwise(p["y"]))
        return F.concat(done, F.array(moved))

    def single(points: Column) -> Column:
        return F.aggregate(
            F.slice(points, F.lit(2), F.size(points)), F.slice(points, 1, 1),
            lambda done, p: F.when(F.element_at(done, -1) == p, done).otherwise(F.concat(done, F.array(p))),
        )

    moved = F.aggregate(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, 1, 1), step)
    ends = let(moved, lambda m: F.concat(F.slice(m, F.lit(1), F.size(m) - 1), F.slice(m, 1, 1)))
    return F.when(F.size(ring) < 4, ring).otherwise(let(let(ends, single), closed))


def bounds(ring: Column) -> Column:
    """(west, south, east, north) of the points."""
    return F.struct(
        F.array_min(F.transform(ring, lambda p: p["x"])).alias("west"), F.array_min(F.transform(ring, lambda p: p["y"])).alias("south"),
        F.array_max(F.transform(ring, lambda p: p["x"])).alias("east"), F.array_max(F.transform(ring, lambda p: p["y"])).alias("north"),
    )


def boxes_touch(a: Column, b: Column) -> Column:
    """Whether two boxes (west, south, east, north) share a point; edges count."""
    return (a["west"] <= b["east"]) & (a["east"] >= b["west"]) & (a["south"] <= b["north"]) & (a["north"] >= b["south"])


def contains(ring: Column, x: Column, y: Column) -> Column:
    """Whether the point is inside the closed ring, by the even-odd rule."""
    crossings = F.zip_with(
        F.slice(ring, F.lit(1), F.size(ring) - 1), F.slice(ring, F.lit(2), F.size(ring) - 1),
        lambda p, q: F.when(
            ((p["y"] > y) != (q["y"] > y)) & (x < (q["x"] - p["x"]) * (y - p["y"]) / F.nullif(q["y"] - p["y"], F.lit(0.0)) + p["x"]), 1
        ).otherwise(0),
    )
    return F.aggregate(crossings, F.lit(0), lambda s, k: s + k) % 2 == 1


def checked_bbox(west: Column, south: Column, east: Column, north: Column) -> Column:
    """The box clamped to the globe; null where west isn't below east or south isn't below north."""
    fine = (west < east) & (south < north)
    return F.when(fine, F.struct(
        F.greatest(west.cast("double"), F.lit(-180.0)).alias("west"), F.greatest(south.cast("double"), F.lit(-90.0)).alias("south"),
        F.least(east.cast("double"), F.lit(180.0)).alias("east"), F.least(north.cast("double"), F.lit(90.0)).alias("north"),
    ))


def segment_meets_box(p: Column, q: Column, box: Column) -> Column:
    """Whether the line from p to q has a point in the box (west, south, east, north), edges included.

    The part of the line inside each pair of sides is a range of its length from 0 to 1; the line meets the box if the
    two ranges overlap.
    """
    def inside(start: Column, end: Column, low: Column, high: Column) -> tuple[Column, Column]:
        step = F.nullif(end - start, F.lit(0.0))
        a, b = (low - start) / step, (high - start) / step
        level = F.when((start >= low) & (start <= high), 0.0).otherwise(2.0)
        return F.coalesce(F.least(a, b), level), F.coalesce(F.greatest(a, b), F.lit(1.0))

    (x0, x1), (y0, y1) = inside(p["x"], q["x"], box["west"], box["east"]), inside(p["y"], q["y"], box["south"], box["north"])
    return F.greatest(x0, y0, F.lit(0.0)) <= F.least(x1, y1, F.lit(1.0))


def box_meets_polygon(box: Column, rings: Column) -> Column:
    """Whether a box and a polygon, outer ring and holes, share a point; touching counts."""
    def crossed(ring: Column) -> Column:
        return F.exists(F.zip_with(
            F.slice(ring, F.lit(1), F.size(ring) - 1), F.slice(ring, F.lit(2), F.size(ring) - 1), lambda p, q: segment_meets_box(p, q, box)
        ), lambda hit: hit)

    corner = lambda ring: contains(ring, box["west"], box["south"])
    holes = F.exists(F.slice(rings, F.lit(2), F.size(rings)), corner)
    return F.exists(rings, crossed) | (corner(F.element_at(rings, 1)) & ~holes)
