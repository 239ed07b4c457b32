"""Polygons from masks and their shapes: tracing, simplifying, rectangles, regularising, as kernels of one shape.

A polygon is a list of closed rings of (x, y), the outer one first. The DataFrame functions below run the kernels in
Arrow batches; each kernel sees one tile or one polygon.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.operators import overlay

Ring = list[tuple[float, float]]
RINGS = "array<array<struct<x:double,y:double>>>"
_ARROW_RINGS = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))


def area(ring: Ring) -> float:
    """The shoelace area of a closed ring, counter-clockwise positive."""
    p = np.asarray(ring)
    return float((p[:-1, 0] * p[1:, 1] - p[1:, 0] * p[:-1, 1]).sum() / 2) if len(p) > 3 else 0.0


Edges = np.ndarray  # rows (label, x0, y0, x1, y1): straight pieces of a label's outline, the label on their right


def outline(label: np.ndarray, whole_runs: bool = True) -> Edges:
    """The outlines of the positive labels of a grid as directed edges along pixel sides, in (column, row).

    Sides of neighbouring pixels that run on are one edge. Without ``whole_runs`` those at the grid's own border stay
    apart, a side each, so that they can cancel against the sides of a neighbouring grid.
    """
    padded, (h, w), out = np.pad(label, 1), label.shape, []
    for dr, dc in ((-1, 0), (1, 0), (0, 1), (0, -1)):
        edge = (label > 0) & (padded[1 + dr : 1 + dr + h, 1 + dc : 1 + dc + w] != label)
        lines, of = (edge, label) if dr else (edge.T, label.T)  # a run goes along the rows of these
        on = np.zeros_like(lines)
        on[:, 1:] = lines[:, 1:] & lines[:, :-1] & (of[:, 1:] == of[:, :-1])
        if not whole_runs:
            on[0 if dr + dc < 0 else -1] = False
        begin = np.argwhere(lines & ~on)
        last = lines.copy()
        last[:, :-1] &= ~on[:, 1:]
        end = np.argwhere(last)  # in the same order, so each begin has its end
        at, lo, hi = begin[:, 0] + (dr + dc > 0), begin[:, 1], end[:, 1] + 1
        start, stop = (lo, hi) if dr < 0 or dc > 0 else (hi, lo)
        xy = (start, at, stop, at) if dr else (at, start, at, stop)
        out.append(np.stack([of[begin[:, 0], begin[:, 1]], *xy], axis=1))
    return np.concatenate(out)


def rings_of(edges: np.ndarray) -> list[Ring]:
    """The rings that directed edges (x0, y0, x1, y1) of one label close, the outer one first; opposite edges cancel.

    Where four edges meet, the turn that keeps diagonal pixels apart is taken. Straight runs become one edge.
    """
    every = {tuple(e) for e in edges.tolist()}
    graph: dict[tuple, list[tuple]] = {}
    for x0, y0, x1, y1 in sorted(every):
        if (x1, y1, x0, y0) not in every:
            graph.setdefault((x0, y0), []).append((x1, y1))
    sign = lambda v: (v > 0) - (v < 0)
    rings: list[Ring] = []
    while graph:
        here = next(iter(graph))
        ring, came = [here], None
        while True:
            nexts = graph[here]
            to = nexts[0]
            if len(nexts) > 1 and came:
                turn = (-sign(here[1] - came[1]), sign(here[0] - came[0]))
                to = next((n for n in nexts if (sign(n[0] - here[0]), sign(n[1] - here[1])) == turn), to)
            nexts.remove(to)
            if not nexts:
                del graph[here]
            came, here = here, to
            ring.append(here)
            if here == ring[0]:
                break
        way = lambda p, q: (sign(q[0] - p[0]), sign(q[1] - p[1]))
        corners = [q for p, q, n in zip([ring[-2], *ring[:-2]], ring[:-1], ring[1:], strict=True) if way(p, q) != way(q, n)]
        rings.append([(float(x), float(y)) for x, y in [*corners, corners[0]]])
    return sorted(rings, key=lambda r: -abs(area(r)))


def trace(label: np.ndarray) -> dict[int, list[Ring]]:
    """The rings, along pixel edges, of each positive label of a grid: the outer one and then its holes."""
    edges = outline(label)
    edges = edges[np.argsort(edges[:, 0], kind="stable")]
    starts = np.flatnonzero(np.concatenate(([True], edges[1:, 0] != edges[:-1, 0]))) if len(edges) else np.zeros(0, np.int64)
    return {int(part[0, 0]): rings_of(part[:, 1:]) for part in np.split(edges, starts[1:]) if len(part)}


def _far(points: np.ndarray, a: int, b: int) -> tuple[int, float]:
    """The point between a and b that is farthest from the line through them, and how far it is."""
    line, rest = points[b] - points[a], points[a + 1 : b] - points[a]
    size = math.hypot(*line)
    far = np.abs(line[0] * rest[:, 1] - line[1] * rest[:, 0]) / size if size else np.hypot(rest[:, 0], rest[:, 1])
    at = int(far.argmax())
    return a + 1 + at, float(far[at])


def _holds(ring: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Which points a ring, not closed, holds; even-odd."""
    p, q = ring[None], np.roll(ring, -1, axis=0)[None]
    x, y = points[:, :1], points[:, 1:]
    over = (p[..., 1] > y) != (q[..., 1] > y)
    with np.errstate(divide="ignore", invalid="ignore"):
        at = (q[..., 0] - p[..., 0]) * (y - p[..., 1]) / (q[..., 1] - p[..., 1]) + p[..., 0]
    return (over & (x < at)).sum(axis=1) % 2 == 1


def _in_the_way(section: np.ndarray, others: np.ndarray) -> bool:
    """Whether the line between a section's ends crosses or touches another segment, or jumps over a point of one."""
    a, b = section[0], section[-1]
    low, high = section.min(axis=0), section.max(axis=0)
    near = (np.minimum(others[:, :2], others[:, 2:]) <= high).all(axis=1) & (np.maximum(others[:, :2], others[:, 2:]) >= low).all(axis=1)
    p, q = others[near, :2], others[near, 2:]
    d, e = b - a, q - p
    cross = lambda u, v: u[..., 0] * v[..., 1] - u[..., 1] * v[..., 0]
    s0, s1, t0, t1 = cross(d, p - a), cross(d, q - a), cross(e, a - p), cross(e, b - p)
    if ((s0 * s1 < 0) & (t0 * t1 < 0)).any():
        return True
    ends = np.concatenate([p, q])
    ends = ends[(ends != a).any(axis=1) & (ends != b).any(axis=1)]
    along = (ends - a) @ d
    return bool(((cross(d, ends - a) == 0) & (along > 0) & (along < d @ d)).any() or (len(ends) and _holds(section, ends).any()))


def simplify(rings: list[Ring], tolerance: float) -> list[Ring]:
    """Rings with fewer points, none farther than the tolerance from the old line, and the same topology.

    Farthest points first: a section becomes a line where all its points are near it and where that line meets no
    segment of any ring, as it is by then, and jumps over no point of one; so rings stay simple, apart, and holes in
    their shell. A ring that would fall below a triangle takes half the tolerance, and in the end stays as it is.
    """
    lines = [np.asarray(r, float) for r in rings]
    segments = [np.hstack([p[:-1], p[1:]]) for p in lines]
    for k, p in enumerate(lines):
        others = np.concatenate([np.zeros((0, 4)), *segments[:k], *segments[k + 1 :]])
        limit, turn = tolerance, int(np.hypot(*(p - p[0]).T).argmax()) if len(p) else 0
        for _ in range(6):
            if not 0 < turn < len(p) - 1:
                break
            alive, stack = np.ones(len(p), bool), [(turn, len(p) - 1), (0, turn)]
            while stack:
                a, b = stack.pop()
                if b - a < 2:
                    continue
                at, far = _far(p, a, b)
                if far <= limit:
                    left = np.flatnonzero(alive)
                    outside = (left[1:] <= a) | (left[:-1] >= b)
                    own = np.hstack([p[left[:-1]], p[left[1:]]])[outside]
                    if not _in_the_way(p[a : b + 1], np.concatenate([others, own])):
                        alive[a + 1 : b] = False
                        continue
                stack += [(at, b), (a, at)]
            if alive.sum() >= 4:
                segments[k] = np.hstack([p[alive][:-1], p[alive][1:]])
                lines[k] = p[alive]
                break
            limit /= 2
    return [[tuple(x) for x in p.tolist()] for p in lines]


def hull(points: Ring) -> Ring:
    """The convex hull, counter-clockwise, not closed."""
    p = sorted(set(points))
    if len(p) < 3:
        return p
    def half(line: Ring) -> Ring:
        out: Ring = []
        for q in line:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]):
                out.pop()
            out.append(q)
        return out[:-1]

    return half(p) + half(p[::-1])


def smallest_rectangle(points: Ring) -> Ring | None:
    """The rectangle of least area around the points, closed; one side lies along a side of their hull."""
    h = np.asarray(hull(points))
    if len(h) < 3:
        return None
    best = None
    for d in np.roll(h, -1, axis=0) - h:
        u = d / math.hypot(*d)
        v = np.array([-u[1], u[0]])
        a, b = h @ u, h @ v
        size = (a.max() - a.min()) * (b.max() - b.min())
        if best is None or size < best[0] - 1e-12:
            best = size, [tuple(s * u + t * v) for s, t in ((a.min(), b.min()), (a.max(), b.min()), (a.max(), b.max()), (a.min(), b.max()))]
    return [*best[1], best[1][0]]


def rectangularize(rings: list[Ring], least_share: float = 0.9) -> list[Ring]:
    """The smallest rectangle, where the polygon fills at least that share of it; else the polygon."""
    own = abs(area(rings[0])) - sum(abs(area(r)) for r in rings[1:])
    box = smallest_rectangle(rings[0])
    if own <= 0 or box is None or own / abs(area(box)) < least_share:
        return rings
    return [box]


def dominant_angle(ring: Ring) -> float:
    """The direction, in degrees, of the longest side of the smallest rectangle; the first of equal ones."""
    box = smallest_rectangle(ring)
    if box is None:
        return 0.0
    sides = [(b[0] - a[0], b[1] - a[1]) for a, b in zip(box, box[1:], strict=False)]
    longest = max(range(4), key=lambda k: (math.hypot(*sides[k]), -k))
    return math.degrees(math.atan2(sides[longest][1], sides[longest][0]))


def smooth(grid: np.ndarray, pixels: int) -> np.ndarray:
    """A mask closed by a disc: grown by ``pixels`` and shrunk again, with room at the edges so that none is lost."""
    wide = np.pad(grid.astype(bool), 2 * pixels)
    disc = [(dr, dc) for dr in range(-pixels, pixels + 1) for dc in range(-pixels, pixels + 1) if dr * dr + dc * dc <= pixels * pixels]
    grown = np.zeros_like(wide)
    for dr, dc in disc:
        grown |= np.roll(wide, (dr, dc), (0, 1))
    back = np.ones_like(wide)
    for dr, dc in disc:
        back &= np.roll(grown, (dr, dc), (0, 1))
    inner = slice(2 * pixels, -2 * pixels or None)
    return back[inner, inner].astype(grid.dtype)


def polygonize(labelled: DataFrame, transform: tuple[float, ...] = (1.0, 0.0, 0.0, 0.0, 1.0, 0.0)) -> DataFrame:
    """(tile_id, label, rings) of labelled(tile_id, r, c, label): one polygon a component, holes kept, through an affine transform."""
    a, b, c0, d, e, f0 = transform

    def of(part: pd.DataFrame) -> list[tuple]:
        grid = np.zeros((int(part["r"].max()) + 1, int(part["c"].max()) + 1), np.int64)
        grid[part["r"], part["c"]] = part["label"] + 1
        return [
            (part["tile_id"].iloc[0], k - 1, [[{"x": a * x + b * y + c0, "y": d * x + e * y + f0} for x, y in ring] for ring in rings])
            for k, rings in trace(grid).items()
        ]

    kind = dict(labelled.dtypes)["tile_id"]
    return overlay.by_runs(labelled.select("tile_id", "r", "c", "label"), ["tile_id"], of, f"tile_id {kind}, label long, rings {RINGS}")


def merged_polygons(labelled: DataFrame, block: int = 512) -> DataFrame:
    """(class_name, label, rings) of a mosaic's labelled(class_name, gr, gc, label): overlapping tiles' regions as one.

    Blocks of the mosaic are outlined each in a task, straight runs as one edge; a region's task gets those edges
    alone, cancels the sides where blocks meet and closes the rings. So what a task holds follows the points of one
    region's outline, which its row holds too, and neither its pixels nor its box.
    """
    name_kind, kind = dict(labelled.dtypes)["class_name"], dict(labelled.dtypes)["label"]

    def outlined(part: pd.DataFrame) -> pd.DataFrame:
        y, x = int(part["gr"].min()), int(part["gc"].min())
        names, number = np.unique(part["label"], return_inverse=True)
        grid = np.zeros((int(part["gr"].max()) - y + 1, int(part["gc"].max()) - x + 1), np.int64)
        grid[part["gr"] - y, part["gc"] - x] = number + 1
        edges = outline(grid, whole_runs=False)
        return pd.DataFrame({
            "class_name": part["class_name"].iloc[0], "label": names[edges[:, 0] - 1],
            **{c: edges[:, k] + o for c, k, o in (("x0", 1, x), ("y0", 2, y), ("x1", 3, x), ("y1", 4, y))},
        })

    def closed(part: pd.DataFrame) -> list[tuple]:
        rings = [[{"x": px, "y": py} for px, py in ring] for ring in rings_of(part[["x0", "y0", "x1", "y1"]].to_numpy())]
        return [(part["class_name"].iloc[0], part["label"].iloc[0], rings)]

    placed = labelled.select(
        "class_name", "label", F.col("gr").cast("long").alias("gr"), F.col("gc").cast("long").alias("gc"),
        F.floor(F.col("gr") / block).alias("_by"), F.floor(F.col("gc") / block).alias("_bx"),
    )
    edges = placed.groupBy("class_name", "_by", "_bx").applyInPandas(outlined, f"class_name {name_kind}, label {kind}, x0 long, y0 long, x1 long, y1 long")
    return overlay.by_runs(edges, ["class_name", "label"], closed, f"class_name {name_kind}, label {kind}, rings {RINGS}")


def repair(rings: list[Ring], grid: float = overlay.GRID) -> list[list[Ring]]:
    """Valid polygons of what the rings enclose an odd number of times: each a closed ring and its holes.

    Rings may cross themselves and each other; points and crossings are taken to the nearest multiple of ``grid``.
    """
    whole = [r for r in (np.rint(np.asarray(ring, float).reshape(-1, 2) / grid).astype(np.int64) for ring in rings) if len(r) > 2]
    if not whole:
        return []
    origin = np.concatenate(whole).min(axis=0)
    found = overlay.overlay([r - origin for r in whole], even_odd=True)
    return [[[tuple(p) for p in ((np.vstack([r, r[:1]]) + origin) * grid).tolist()] for r in polygon] for polygon in found]


def united_cells(polygons: DataFrame, keys: list[str], rings: str = "rings") -> DataFrame:
    """(keys, label, rings): the cells of the unit grid whose centres polygons cover, for each value of keys, a row for
    each connected part; ``overlay.united`` unites the polygons themselves.

    Polygons become the cells that they cover, once each, and the cells' regions are traced anew, block by block; no
    task holds a key's polygons. Rows with a null key are united like those of any other value. ``label`` is the part's
    least cell.
    """
    from rasterloom.operators.labels import covered_cells
    from rasterloom.operators.morphology import mosaic_components

    name = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    cells = covered_cells(polygons.select(name.alias("class_name"), F.col(rings).alias("rings")), ["class_name"])
    labelled = mosaic_components(cells.select("class_name", F.col("r").alias("gr"), F.col("c").alias("gc")), keys=["class_name"])
    fields = ", ".join(f"{c} {dict(polygons.dtypes)[c]}" for c in keys)
    parts = merged_polygons(labelled.select("class_name", "gr", "gc", F.col("label").alias("label")))
    return parts.select(F.from_json("class_name", fields).alias("k"), "label", "rings").select(*[F.col(f"k.{c}").alias(c) for c in keys], "label", "rings")


def _ring(ring: np.ndarray) -> Ring:
    return [tuple(p) for p in ring.tolist()]


def _rings(rings: list[Ring]) -> list[np.ndarray]:
    return [np.asarray(r, float).reshape(-1, 2) for r in rings]


def _sliced(some: Callable[[pa.Array], pa.Array]):
    """An Arrow function that works on AT_ONCE rows at a time, so that few of them are Python objects."""
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.concat_arrays([some(batch.slice(k, overlay.AT_ONCE)) for k in range(0, max(1, len(batch)), overlay.AT_ONCE)])

    return of


def _each(kernel: Callable[[list[Ring]], list[Ring]]):
    """A column function of rings to rings. It takes Arrow arrays: rings of unequal lengths have no pandas form."""
    def some(column: pa.Array) -> pa.Array:
        return overlay.many_rings([None if rings is None else _rings(kernel([_ring(r) for r in rings])) for rings in overlay.shapes_of(column, whole=True)])

    return F.arrow_udf(_sliced(some), RINGS)


def each_part(kernel: Callable[[list[list[Ring]]], list[list[Ring]]]):
    """A column function of multipolygons to multipolygons, as ``_each``."""
    def some(column: pa.Array) -> pa.Array:
        places, polygons = overlay.lists(column)
        parts = overlay.shapes_of(polygons, whole=True)
        rows = [parts[a:b] if there else None for there, a, b in places]
        return overlay.multipolygons([None if row is None else [_rings(p) for p in kernel([[_ring(r) for r in p] for p in row])] for row in rows])

    return F.arrow_udf(_sliced(some), f"array<{RINGS}>")


def simplified(polygons: DataFrame, tolerance: float) -> DataFrame:
    return polygons.withColumn("rings", _each(lambda r: simplify(r, tolerance))("rings")) if tolerance > 0 else polygons


def rectangularized(polygons: DataFrame, least_share: float = 0.9) -> DataFrame:
    return polygons.withColumn("rings", _each(lambda r: rectangularize(r, least_share))("rings"))


def _snapped(ring: Ring, slope: float) -> Ring:
    """A closed ring whose edges within a slope of an axis run along it; points that fall together become one."""
    moved = ring[:1]
    for x, y in ring[1:]:
        last = moved[-1]
        dx, dy = abs(x - last[0]), abs(y - last[1])
        level = dx > 0 and dy <= dx * slope
        upright = not level and dy > 0 and dx <= dy * slope
        moved.append((last[0] if upright else x, last[1] if level else y))
    moved[-1] = moved[0]
    out = [p for k, p in enumerate(moved) if not k or p != moved[k - 1]]
    return out if out[0] == out[-1] else [*out, out[0]]


def _middle(ring: Ring) -> tuple[float, float] | None:
    """The centre of mass; None of a ring without an area."""
    p = np.asarray(ring)
    w = p[:-1, 0] * p[1:, 1] - p[1:, 0] * p[:-1, 1]
    return tuple(((p[:-1] + p[1:]) * w[:, None]).sum(axis=0) / (3 * w.sum())) if len(p) > 3 and w.sum() != 0 else None


def _turned(ring: Ring, degrees: float, centre: tuple[float, float]) -> Ring:
    c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    (mx, my) = centre
    return [(mx + (x - mx) * c - (y - my) * s, my + (x - mx) * s + (y - my) * c) for x, y in ring]


def _whole_area(rings: list[Ring]) -> float:
    return abs(area(rings[0])) - sum(abs(area(r)) for r in rings[1:])


def regularize(rings: list[Ring], tolerance: float, angle_tolerance: float, least_ratio: float, most_ratio: float) -> list[Ring]:
    """A polygon with its edges drawn along its own two main directions, as ``regularized`` says."""
    if not rings or len(rings[0]) < 4:
        return rings
    before, angle = _whole_area(rings), dominant_angle(rings[0])
    plain = simplify(rings, tolerance) if tolerance > 0 else rings
    centre = _middle(plain[0])
    if centre is None or before == 0:
        return plain
    slope = math.tan(math.radians(angle_tolerance))
    level = [_snapped(r, slope) if len(r) > 3 else r for r in (_turned(r, -angle, centre) for r in plain)]
    level = [r for r in level if len(r) > 3]
    centre = _middle(level[0]) if level else None
    if centre is None:
        return plain
    back = [_turned(r, angle, centre) for r in level]
    return back if least_ratio <= _whole_area(back) / before <= most_ratio else plain


def regularized(
    polygons: DataFrame, tolerance: float = 0.0, angle_tolerance: float = 12.0, least_ratio: float = 0.7, most_ratio: float = 1.35
) -> DataFrame:
    """polygons with their edges drawn along their own two main directions.

    A polygon is simplified, turned by its dominant angle about its centroid, snapped to the axes and turned back
    about the snapped centroid. It stays simplified only where the area changes by more than the two ratios, and where
    it has none.
    """
    return polygons.withColumn("rings", _each(lambda r: regularize(r, tolerance, angle_tolerance, least_ratio, most_ratio))("rings"))


def multipolygon(rings: str = "rings"):
    """A polygon's rings as a multipolygon of one part."""
    return F.array(F.col(rings))
