"""Polygon overlay: validity, unions and offsets of polygons with any coordinates.

A kernel nodes all segments on an integer grid, labels both sides of each edge by a sweep over x, keeps the edges with
the inside on one side only and chains them to rings. Its predicates are exact: coordinates of a cell are integers of at
most 29 bits, so products fit 64. On tables, polygons are dealt to cells by what they cover, each cell is one task's work,
borders cancel side by side, and the parts of a region are found as components of cells' parts that share a border. No
task holds a key's polygons.

Rings are arrays of (x, y) rows, not closed; in results the inside lies on the right, so shells have a negative area.
"""

from __future__ import annotations

import bisect
import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.operators.graph import components, stored

RINGS = "array<array<struct<x:double,y:double>>>"
GRID = 1 / 1024  # the distance of grid points, in the unit of the coordinates
SPAN = 1 << 29
AT_ONCE = 512  # rows of a column that are worked on at once
_POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])

Rings = list[np.ndarray]
Polygon = list[np.ndarray]  # the shell and its holes


# --- the kernel, on integers ---


def _turned(rows: np.ndarray, by: int) -> np.ndarray:
    """rows from the place ``by`` on, the others after them; np.roll takes many times as long for few rows."""
    return np.concatenate((rows[by:], rows[:by]))


def ring_area(ring: np.ndarray) -> float:
    """The shoelace area, counter-clockwise positive."""
    p = ring - ring[0]
    q = _turned(p, 1)
    return float((p[:, 0] * q[:, 1] - q[:, 0] * p[:, 1]).sum()) / 2


def _segments(rings: Rings) -> np.ndarray:
    parts = [np.hstack([r, _turned(r, 1)]) for r in rings if len(r) > 2]
    s = np.concatenate(parts) if parts else np.zeros((0, 4), np.int64)
    return s[(s[:, :2] != s[:, 2:]).any(axis=1)]


def _near_pairs(s: np.ndarray, most: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of segments whose boxes meet, by a sweep along x, in portions."""
    x0, x1 = np.minimum(s[:, 0], s[:, 2]), np.maximum(s[:, 0], s[:, 2])
    y0, y1 = np.minimum(s[:, 1], s[:, 3]), np.maximum(s[:, 1], s[:, 3])
    order = np.argsort(x0, kind="stable")
    count = np.searchsorted(x0[order], x1[order], side="right") - np.arange(len(s)) - 1
    ends = np.cumsum(count)
    begin = 0
    while begin < len(s):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + most, side="right")))
        n = count[begin:end]
        i = np.repeat(np.arange(begin, end), n)
        j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + i + 1
        i, j = order[i], order[j]
        meet = (y0[i] <= y1[j]) & (y0[j] <= y1[i])
        yield i[meet], j[meet]
        begin = end


def _cross(ax, ay, bx, by):
    return ax * by - ay * bx


def _cuts(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(segment, point) where a segment passes an end of another one or crosses it, its own ends left out."""
    of, points = [], []

    def note(k: np.ndarray, p: np.ndarray) -> None:
        own = (p == s[k, :2]).all(axis=1) | (p == s[k, 2:]).all(axis=1)
        of.append(k[~own])
        points.append(p[~own])

    for i, j in _near_pairs(s):
        a, b = s[i], s[j]
        d, e = a[:, 2:] - a[:, :2], b[:, 2:] - b[:, :2]
        sides = [
            _cross(d[:, 0], d[:, 1], b[:, 0] - a[:, 0], b[:, 1] - a[:, 1]), _cross(d[:, 0], d[:, 1], b[:, 2] - a[:, 0], b[:, 3] - a[:, 1]),
            _cross(e[:, 0], e[:, 1], a[:, 0] - b[:, 0], a[:, 1] - b[:, 1]), _cross(e[:, 0], e[:, 1], a[:, 2] - b[:, 0], a[:, 3] - b[:, 1]),
        ]
        for k, other, of_points, side in ((i, a, b[:, :2], 0), (i, a, b[:, 2:], 1), (j, b, a[:, :2], 2), (j, b, a[:, 2:], 3)):
            lo, hi = np.minimum(other[:, :2], other[:, 2:]), np.maximum(other[:, :2], other[:, 2:])
            on = (sides[side] == 0) & (of_points >= lo).all(axis=1) & (of_points <= hi).all(axis=1)
            note(k[on], of_points[on])
        proper = (np.sign(sides[0]) * np.sign(sides[1]) < 0) & (np.sign(sides[2]) * np.sign(sides[3]) < 0)
        if proper.any():
            p, q = sides[2][proper].astype(float), sides[3][proper].astype(float)
            at = a[proper, :2] + np.rint((p / (p - q))[:, None] * d[proper]).astype(np.int64)
            note(i[proper], at)
            note(j[proper], at)
    if not of:
        return np.zeros(0, np.int64), np.zeros((0, 2), np.int64)
    return np.concatenate(of), np.concatenate(points)


def _counted(s: np.ndarray, forward: np.ndarray, backward: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different segments, from their lesser end, and how often each runs forward and backward."""
    s, forward, backward = (x[(s[:, :2] != s[:, 2:]).any(axis=1)] for x in (s, forward, backward))
    flip = (s[:, 0] > s[:, 2]) | ((s[:, 0] == s[:, 2]) & (s[:, 1] > s[:, 3]))
    s = np.where(flip[:, None], s[:, [2, 3, 0, 1]], s)
    forward, backward = np.where(flip, backward, forward), np.where(flip, forward, backward)
    if not len(s):
        return s, forward, backward
    order = np.lexsort(s.T[::-1])
    s = s[order]
    first = np.flatnonzero(np.concatenate(([True], (s[1:] != s[:-1]).any(axis=1))))
    return s[first], np.add.reduceat(forward[order], first), np.add.reduceat(backward[order], first)


def _weight(forward: np.ndarray, backward: np.ndarray, even_odd: bool) -> np.ndarray:
    """By how much the winding on the right of a segment exceeds that on its left."""
    return (forward + backward) % 2 if even_odd else forward - backward


def _weighing(s: np.ndarray, forward: np.ndarray, backward: np.ndarray, even_odd: bool | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kept = slice(None) if even_odd is None else _weight(forward, backward, even_odd) != 0
    return s[kept], forward[kept], backward[kept]


def noded(s: np.ndarray, rounds: int = 60, starts: np.ndarray | None = None, even_odd: bool | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments cut at all points where they meet, each once, with how often it runs forward and backward.

    Crossings are rounded to the grid; that moves segments a little, so it is done until nothing crosses. Of shapes side
    by side, which begin at the places ``starts`` along x, each is done when nothing of its own crosses.
    """
    s, forward, backward = _counted(s, np.ones(len(s), np.int64), np.zeros(len(s), np.int64))
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        k, points = _cuts(s)
        if not len(k):
            if not done:
                return s, forward, backward
            s, forward, backward = (np.concatenate(x) for x in zip(*done, (s, forward, backward), strict=True))
            order = np.lexsort(s.T[::-1])
            return s[order], forward[order], backward[order]
        if starts is not None:
            shape = np.searchsorted(starts, s[:, 0], side="right")
            crosses = np.isin(shape, shape[k])
            if not crosses.all():
                done.append((s[~crosses], forward[~crosses], backward[~crosses]))
                k = (np.cumsum(crosses) - 1)[k]
                s, forward, backward = s[crosses], forward[crosses], backward[crosses]
        every = np.concatenate([np.arange(len(s)), k, np.arange(len(s))])
        at = np.concatenate([s[:, :2], points, s[:, 2:]])
        along = ((at - s[every, :2]) * (s[:, 2:] - s[:, :2])[every]).sum(axis=1).astype(float)
        along[: len(s)], along[len(s) + len(k) :] = -np.inf, np.inf
        order = np.lexsort((along, every))
        every, at = every[order], at[order]
        joined = every[1:] == every[:-1]
        of = every[1:][joined]
        s, forward, backward = _weighing(*_counted(np.hstack([at[:-1], at[1:]])[joined], forward[of], backward[of]), even_odd)
    raise ArithmeticError(f"segments still cross after {rounds} rounds")


def _left_windings(edges: np.ndarray, weight: np.ndarray, at_once: int = 96) -> np.ndarray:
    """The winding on the left of each edge: the weights of the edges over its middle, taken strip by strip along x."""
    middle, out = edges[:, :2] + edges[:, 2:], np.zeros(len(edges), np.int64)  # twice the middle
    upright = edges[:, 0] == edges[:, 2]
    order = np.argsort(middle[:, 0], kind="stable")
    flat = ~upright
    f, w = edges[flat], weight[flat]
    for begin in range(0, len(order), at_once):
        q = order[begin : begin + at_once]
        x, y, up = middle[q, 0][:, None], middle[q, 1][:, None], upright[q][:, None]
        near = (2 * f[:, 0] <= x.max()) & (2 * f[:, 2] >= x.min())
        g, h = f[near], w[near]
        over = np.where(up, (2 * g[:, 0] < x) & (x <= 2 * g[:, 2]), (2 * g[:, 0] <= x) & (x < 2 * g[:, 2]))
        above = _cross(g[:, 2] - g[:, 0], g[:, 3] - g[:, 1], x - 2 * g[:, 0], y - 2 * g[:, 1]) < 0
        out[q] = ((over & above) * h).sum(axis=1)
    return out


def boundary(s: np.ndarray, even_odd: bool, starts: np.ndarray | None = None) -> np.ndarray:
    """The edges between inside and outside of what directed segments wind around, the inside on their right."""
    edges, forward, backward = noded(s, starts=starts, even_odd=even_odd)
    weight = _weight(forward, backward, even_odd)
    if not len(edges):
        return edges
    left = _left_windings(edges, weight)
    right = left + weight
    inside_left, inside_right = (left % 2 == 1, right % 2 == 1) if even_odd else (left > 0, right > 0)
    kept = inside_left != inside_right
    return np.where(inside_right[kept][:, None], edges[kept], edges[kept][:, [2, 3, 0, 1]])


def _angle_order(a: tuple[int, int], b: tuple[int, int]) -> int:
    """Compares directions by their angle from the positive x axis, exactly."""
    half = lambda v: 0 if v[1] > 0 or (v[1] == 0 and v[0] > 0) else 1
    if half(a) != half(b):
        return half(a) - half(b)
    turn = a[0] * b[1] - a[1] * b[0]
    return -1 if turn > 0 else 1 if turn < 0 else 0


def chained(edges: np.ndarray) -> Rings:
    """The rings that boundary edges form. Where several meet in a point, regions that touch there only stay apart, and a
    ring that comes through a point twice is cut in two."""
    starts: dict[tuple[int, int], list[int]] = {}
    rows = edges.tolist()
    for k, (x, y, _, _) in enumerate(rows):
        starts.setdefault((x, y), []).append(k)
    follow = [0] * len(rows)
    crowded: dict[tuple[int, int], list[int]] = {}
    for k, (_, _, x, y) in enumerate(rows):
        out = starts[x, y]
        if len(out) == 1:
            follow[k] = out[0]
        else:
            crowded.setdefault((x, y), []).append(k)
    for (x, y), incoming in crowded.items():
        ends = [((rows[k][2] - x, rows[k][3] - y), k, True) for k in starts[x, y]] + [((rows[k][0] - x, rows[k][1] - y), k, False) for k in incoming]
        ends.sort(key=functools.cmp_to_key(lambda a, b: _angle_order(a[0], b[0])))
        for at, (_, k, out) in enumerate(ends):
            if not out:  # the first way out, counter-clockwise, closes the wedge of the inside
                n = at + 1
                while not ends[n % len(ends)][2]:
                    n += 1
                follow[k] = ends[n % len(ends)][1]
    rings, seen = [], [False] * len(rows)
    for k in range(len(rows)):
        path: list[tuple[int, int]] = []
        place: dict[tuple[int, int], int] = {}
        while not seen[k]:
            seen[k] = True
            p = (rows[k][0], rows[k][1])
            if p in place:
                loop = path[place[p] :]
                rings.append(np.array(loop, np.int64))
                for gone in loop:
                    del place[gone]
                del path[len(path) - len(loop) :]
            place[p] = len(path)
            path.append(p)
            k = follow[k]
        if path:
            rings.append(np.array(path, np.int64))
    return rings


def straightened(ring: np.ndarray) -> np.ndarray:
    """A ring without the points inside its straight runs."""
    a, b = ring - _turned(ring, -1), _turned(ring, 1) - ring
    return ring[_cross(a[:, 0], a[:, 1], b[:, 0], b[:, 1]) != 0]


def _holds(ring: np.ndarray, x2: int, y2: int) -> bool:
    """Whether a ring holds the point (x2, y2) / 2, which doesn't lie on it."""
    p, q = ring, _turned(ring, 1)
    low = np.where((p[:, :1] <= q[:, :1]), p, q)
    high = np.where((p[:, :1] <= q[:, :1]), q, p)
    over = (2 * low[:, 0] <= x2) & (x2 < 2 * high[:, 0])
    return bool((over & (_cross(high[:, 0] - low[:, 0], high[:, 1] - low[:, 1], x2 - 2 * low[:, 0], y2 - 2 * low[:, 1]) < 0)).sum() % 2)


def polygons_of(rings: Rings) -> list[Polygon]:
    """Shells with their holes: each hole goes to the smallest shell around it."""
    sizes = [ring_area(r) for r in rings]
    shells = sorted((k for k, a in enumerate(sizes) if a < 0), key=lambda k: -sizes[k])
    out = {k: [rings[k]] for k in shells}
    if shells:
        low, high = (np.array([f(rings[k], axis=0) for k in shells]) for f in (np.min, np.max))
    for k, size in enumerate(sizes):
        if size <= 0 or not shells:
            continue
        hole = rings[k]
        x2, y2 = (hole[0] + hole[1]).tolist()
        around = np.flatnonzero((low <= hole.min(axis=0)).all(axis=1) & (high >= hole.max(axis=0)).all(axis=1))
        home = next((shells[c] for c in around if -sizes[shells[c]] > size and _holds(rings[shells[c]], x2, y2)), None)
        if home is not None:
            out[home].append(hole)
    return [[straightened(r) for r in polygon] for polygon in out.values()]


def overlay(rings: Rings, even_odd: bool) -> list[Polygon]:
    """The polygons of what rings enclose: an odd number of times, or with a winding of at least one."""
    return polygons_of(chained(boundary(_segments(rings), even_odd)))


def overlays(shapes: list[np.ndarray], even_odd: bool, most: int = 1 << 14) -> list[list[Polygon]]:
    """``overlay`` of each of many shapes, given as directed segments.

    Shapes are set side by side along x, about ``most`` segments at once, so that a small one costs no calls of its own.
    All that is computed are differences of coordinates within a shape, so its polygons are the same as alone.
    """
    out: list[list[Polygon]] = []
    begin = 0
    while begin < len(shapes):
        end, total = begin + 1, len(shapes[begin])
        while end < len(shapes) and total + len(shapes[end]) <= most:
            total += len(shapes[end])
            end += 1
        moved, starts, moves, at = [], [], [], 0
        for s in shapes[begin:end]:
            low, high = (int(f(s[:, [0, 2]])) for f in (np.min, np.max)) if len(s) else (0, 0)
            moves.append(at - low)
            starts.append(at)
            moved.append(s + np.array([at - low, 0, at - low, 0]))
            at += high - low + 2
        found: list[Rings] = [[] for _ in starts]
        for ring in chained(boundary(np.concatenate(moved), even_odd, np.array(starts))):
            k = bisect.bisect_right(starts, int(ring[0, 0])) - 1
            found[k].append(ring - (moves[k], 0))
        out += [polygons_of(rings) for rings in found]
        begin = end
    return out


def clipped(ring: np.ndarray, x0: int, y0: int, x1: int, y1: int) -> np.ndarray:
    """A ring within a box: where it leaves the box it runs along its border."""
    for axis, limit, keep_above in ((0, x0, True), (0, x1, False), (1, y0, True), (1, y1, False)):
        if not len(ring):
            break
        p, q = ring, _turned(ring, 1)
        inside = p[:, axis] >= limit if keep_above else p[:, axis] <= limit
        if inside.all():
            continue
        crosses = inside != np.roll(inside, -1)
        #: Taken from the lesser end, so the cells on both sides of a border find the same point.
        swap = (p[:, axis] > q[:, axis])[:, None]
        a, b = np.where(swap, q, p), np.where(swap, p, q)
        span = np.where(b[:, axis] == a[:, axis], 1, b[:, axis] - a[:, axis])
        at = a.copy()
        at[:, 1 - axis] += np.rint((limit - a[:, axis]) / span * (b[:, 1 - axis] - a[:, 1 - axis])).astype(np.int64)
        at[:, axis] = limit
        both = np.stack([p, at], axis=1).reshape(-1, 2)
        ring = both[np.stack([inside, crosses], axis=1).ravel()]
    return ring


def offset(polygons: list[Polygon], distance: float, quarter: int = 16) -> list[Polygon]:
    """Polygons grown by a distance with round corners; a negative one shrinks them."""
    return offsets([polygons], distance, quarter)[0]


def offsets(shapes: list[list[Polygon]], distance: float, quarter: int = 16) -> list[list[Polygon]]:
    """``offset`` of each of many shapes."""
    if distance == 0:
        return shapes
    out: list[list[Polygon]] = [[] for _ in shapes]
    full = [k for k, polygons in enumerate(shapes) if polygons]
    rings = [[r for p in shapes[k] for r in p] for k in full]
    if distance > 0:
        found = overlays([_segments([_raw_offset(r, distance, quarter) for r in of]) for of in rings], even_odd=False)
    else:
        room, frames, corners = int(math.ceil(-distance)) * 4 + 4, [], []
        for of in rings:
            every = np.concatenate(of)
            (x0, y0), (x1, y1) = every.min(axis=0) - room, every.max(axis=0) + room
            frames.append([[np.array([(x0, y0), (x0, y1), (x1, y1), (x1, y0)]), *[r[::-1] for r in of]]])
            corners.append((x0, y0))
        around = offsets(frames, -distance, quarter)
        inner = [[r for p in a for k, r in enumerate(p) if k or (r.min(axis=0) > low).all()] for a, low in zip(around, corners, strict=True)]  # all but the frame
        found = overlays([_segments([r[::-1] for r in of]) for of in inner], even_odd=False)
    for k, polygons in zip(full, found, strict=True):
        out[k] = polygons
    return out


def _raw_offset(ring: np.ndarray, distance: float, quarter: int) -> np.ndarray:
    """A closed path that winds around what a ring holds and what it gains on its left: a rectangle along each side and a
    sector around each corner that sticks out.

    At a corner that points inwards the path goes from one side's rectangle by the corner to the next one's, unless the
    rectangles of some sides are cut where they meet, see ``_cut_chains``.
    """
    p = ring.astype(float)
    ahead = _turned(p, 1) - p
    size = np.hypot(ahead[:, 0], ahead[:, 1])
    normal = np.stack([-ahead[:, 1], ahead[:, 0]], axis=1) / size[:, None] * distance
    before = _turned(normal, -1)
    turn = before[:, 0] * normal[:, 1] - before[:, 1] * normal[:, 0]
    along = (before * normal).sum(axis=1)
    cut = _cut_chains(p, ahead / size[:, None], size, normal / distance, np.arctan2(turn, along), distance)
    out: list[tuple[float, float]] = []
    for k, ((x, y), (bx, by), (nx, ny), turned) in enumerate(zip(p.tolist(), before.tolist(), normal.tolist(), turn.tolist(), strict=True)):
        if k in cut:
            out += cut[k]
        elif turned > 0:
            out += [(x + bx, y + by), (x, y), (x + nx, y + ny)]
        else:
            angle = -abs(math.atan2(turned, float(along[k])))
            steps = max(1, math.ceil(-angle / (math.pi / 2) * quarter))
            arc = [(math.cos(angle * i / steps), math.sin(angle * i / steps)) for i in range(1, steps)]
            out += [(x + bx, y + by), *[(x + c * bx - s * by, y + s * bx + c * by) for c, s in arc], (x + nx, y + ny)]
    return np.rint(np.array(out)).astype(np.int64)


def _cut_chains(p: np.ndarray, way: np.ndarray, size: np.ndarray, up: np.ndarray, turn: np.ndarray, distance: float) -> dict[int, list[tuple[float, float]]]:
    """The points that the path of ``_raw_offset`` takes at corners in the place of rectangles' ends: at the first corner of a
    chain all of its points, none at its others.

    A chain is a run of sides whose corners all point inwards and turn by at most a right angle in all. What its rectangles
    cover is bounded by the lines at their far ends, if no rectangle reaches over the chain's ends: a side whose line lies
    beyond the crossing of its neighbours' lines drops out. So an arc that is shrunk to its middle is one point, where the
    ends of all its rectangles would cross each other.
    """
    n, half = len(p), math.pi / 2 + 1e-6
    inward = (turn > 0) & (turn <= half)
    if not inward.any():
        return {}
    slack = 2 + distance / 50  # corners lie on the grid, so the sides' directions are a little off
    level = (p * up).sum(axis=1) + distance
    ps, ways, ups, sizes, levels, turns, inwards = p.tolist(), way.tolist(), up.tolist(), size.tolist(), level.tolist(), turn.tolist(), inward.tolist()

    def dot(a, b) -> float:
        return a[0] * b[0] + a[1] * b[1]

    def meet(a: int, b: int) -> tuple[float, float] | None:
        (ax, ay), (bx, by) = ups[a], ups[b]
        det = ax * by - ay * bx
        return ((levels[a] * by - levels[b] * ay) / det, (ax * levels[b] - bx * levels[a]) / det) if det > 1e-9 else None

    def points(sides: list[int]) -> tuple[list[tuple[float, float]], float, float] | None:
        """The chain's points, and how far along its first and its last side the first and the last of them lie."""
        kept, found = [sides[0]], []
        for k in sides[1:]:
            at = meet(kept[-1], k)
            while at and found and dot(ways[kept[-1]], at) <= dot(ways[kept[-1]], found[-1]):
                kept.pop()
                found.pop()
                at = meet(kept[-1], k)
            if at is None:
                return None
            kept.append(k)
            found.append(at)
        first, last = sides[0], sides[-1]
        begin, end = dot(ways[first], found[0]) - dot(ways[first], ps[first]), dot(ways[last], found[-1]) - dot(ways[last], ps[last])
        if not (-slack <= begin <= sizes[first] + slack and -slack <= end <= sizes[last] + slack):
            return None
        low, high = dot(ways[first], ps[first]) - slack, dot(ways[last], ps[last]) + sizes[last] + slack
        for a, b in zip(sides, sides[1:], strict=False):
            for k in (a, b):
                tip = (ps[b][0] + ups[k][0] * distance, ps[b][1] + ups[k][1] * distance)
                if dot(ways[first], tip) < low or dot(ways[last], tip) > high:
                    return None
        return found, begin, end

    begins = [k for k in range(n) if not inwards[k] or sizes[k - 1] >= 2 * distance]
    shift = begins[0] if begins else 0
    out: dict[int, list[tuple[float, float]]] = {}
    ends: dict[int, float] = {}  # of sides that a chain ends with, where
    opened: dict[int, tuple[float, list[int]]] = {}  # of sides that a chain begins with, where, and its corners
    k = 0
    while k < n:
        corner = (shift + k) % n
        if not inwards[corner]:
            k += 1
            continue
        corners, total = [corner], turns[corner]
        while k + len(corners) < n and len(corners) < n - 2 and sizes[corners[-1]] < 2 * distance:
            following = (corners[-1] + 1) % n
            if not inwards[following] or total + turns[following] > half:
                break
            total += turns[following]
            corners.append(following)
        for less in range(min(5, 2 * len(corners) - 1)):  # less of the chain's ends: a side there may be too short
            for left in range(less + 1):
                part = corners[left : len(corners) - (less - left)]
                found = points([(part[0] - 1) % n, *part]) if part else None
                if found and found[1] >= ends.get((part[0] - 1) % n, -math.inf):
                    out |= {part[0]: found[0]} | {c: [] for c in part[1:]}
                    ends[part[-1]] = found[2]
                    opened[(part[0] - 1) % n] = found[1], part
                    break
            else:
                continue
            break
        k += len(corners)
    for side in set(ends) & set(opened):  # the first chain may begin with the side that the last one ends with
        if opened[side][0] < ends[side]:
            for c in opened[side][1]:
                out.pop(c)
    return out


# --- rings of a column ---


def lists(column: pa.Array) -> tuple[list[tuple[bool, int, int]], pa.Array]:
    """For each list of an array whether it is there, and where its values begin and end; and the values, of this part alone."""
    if not len(column):  # Java sends no offsets of an empty array
        return [], column.values.slice(0, 0)
    ends = column.offsets.to_numpy()
    there = column.is_valid().to_numpy(zero_copy_only=False)
    places = (ends - ends[0]).tolist()
    return list(zip(there.tolist(), places[:-1], places[1:], strict=True)), column.values.slice(int(ends[0]), int(ends[-1] - ends[0]))


def shapes_of(column: pa.Array, whole: bool = False) -> list[Rings | None]:
    """The rings, as rows (x, y), of each row of an array of rings; empty and null ones go, but with ``whole`` stay, empty."""
    rows, rings = lists(column)
    outlines, points = lists(rings)
    xy = np.stack([np.asarray(points.field(c).to_numpy(zero_copy_only=False), float) for c in ("x", "y")], axis=1)
    inner = [xy[a:b] if there and b > a else xy[:0] if whole else None for there, a, b in outlines]
    return [[r for r in inner[a:b] if r is not None] if there else None for there, a, b in rows]


def _nested(sizes: list[int], values: pa.Array, gone: list[bool] | None = None) -> pa.Array:
    ends = pa.array(np.concatenate(([0], np.cumsum(np.array(sizes, np.int64)))), pa.int32())
    return pa.ListArray.from_arrays(ends, values, mask=pa.array(gone) if gone is not None and any(gone) else None)


def many_rings(shapes: list[list[np.ndarray] | None]) -> pa.Array:
    """An array of rings, of rows (x, y) each."""
    rings = [r for s in shapes if s is not None for r in s]
    xy = np.concatenate([np.zeros((0, 2)), *rings])
    points = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], fields=list(_POINT))
    return _nested([0 if s is None else len(s) for s in shapes], _nested([len(r) for r in rings], points), [s is None for s in shapes])


def multipolygons(shapes: list[list[list[np.ndarray]] | None]) -> pa.Array:
    """An array of multipolygons of rings of rows (x, y)."""
    polygons = many_rings([p for s in shapes if s is not None for p in s])
    return _nested([0 if s is None else len(s) for s in shapes], polygons, [s is None for s in shapes])


def _origin(rings: Rings, grid: float) -> tuple[float, float]:
    every = np.concatenate(rings)
    low = every.min(axis=0)
    if (every.max(axis=0) - low).max() / grid > SPAN / 4:
        raise ValueError("a polygon's box is too large for the grid; take a coarser one")
    return math.floor(low[0] / grid) * grid, math.floor(low[1] / grid) * grid


def _whole(rings: Rings, origin: tuple[float, float], grid: float) -> Rings:
    out = []
    for p in rings:
        p = np.rint((p - origin) / grid).astype(np.int64)
        if len(p) > 1 and (p[0] == p[-1]).all():
            p = p[:-1]
        out.append(p)
    return [r for r in out if len(r) > 2]


def _closed_ring(ring: np.ndarray, origin: tuple[float, float], grid: float) -> np.ndarray:
    p = ring * grid + np.asarray(origin)
    return np.vstack([p, p[:1]])


def _closed(ring: np.ndarray, origin: tuple[float, float], grid: float) -> list[dict]:
    return [{"x": x, "y": y} for x, y in _closed_ring(ring, origin, grid).tolist()]


def _kernel(of, grid: float):
    """A column function of rings to multipolygons; ``of`` takes the segments of many rows, on the grid, at once.

    Rows are taken AT_ONCE at a time from Arrow's own arrays, so a task holds few of them as Python objects.
    """
    def some(column: pa.Array) -> pa.Array:
        shapes = shapes_of(column)
        full = [k for k, shape in enumerate(shapes) if shape]
        origins = [_origin(shapes[k], grid) for k in full]
        found = of([_segments(_whole(shapes[k], origin, grid)) for k, origin in zip(full, origins, strict=True)])
        out = [None if shape is None else [] for shape in shapes]
        for k, origin, polygons in zip(full, origins, found, strict=True):
            out[k] = [[_closed_ring(r, origin, grid) for r in polygon] for polygon in polygons]
        return multipolygons(out)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.concat_arrays([some(batch.slice(k, AT_ONCE)) for k in range(0, max(1, len(batch)), AT_ONCE)])

    return F.arrow_udf(run, f"array<{RINGS}>")


def spread(rows: DataFrame) -> DataFrame:
    """rows dealt evenly over as many tasks as a shuffle has: a small file of shapes is one partition, but hours of work."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def by_runs(rows: DataFrame, keys: list[str], of: Callable[[pd.DataFrame], list[tuple]], schema: str) -> DataFrame:
    """rows under a function of all rows of equal keys, which returns rows of ``schema``.

    As a grouping in pandas, but many small groups are a batch and not one each, and they are dealt over as many tasks as a
    shuffle has: Spark makes few tasks of few bytes, whatever their work. A task holds two batches, or its largest group.
    """
    names = [c.split()[0] for c in schema.split(", ")]

    def whole(frame: pd.DataFrame) -> pd.DataFrame:
        found = [row for _, part in frame.groupby(keys, sort=False, dropna=False) for row in of(part)]
        return pd.DataFrame(found, columns=names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            last = np.ones(len(batch), bool)
            for k in keys:
                end = batch[k].iloc[-1]
                last &= (batch[k].isna() if pd.isna(end) else batch[k] == end).to_numpy(bool)
            begin = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            if held and (begin or any(pd.isna(a) != pd.isna(b) or not (pd.isna(a) or a == b) for a, b in zip(held[-1][keys].iloc[-1], batch[keys].iloc[0], strict=True))):
                yield whole(pd.concat([*held, batch.iloc[:begin]], ignore_index=True))
                held = []
            elif begin:
                yield whole(batch.iloc[:begin])
            held.append(batch.iloc[begin:])
        if held:
            yield whole(pd.concat(held, ignore_index=True))

    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, *keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


def repaired(polygons: DataFrame, rings: str = "rings", geometry: str = "geometry", grid: float = GRID) -> DataFrame:
    """polygons with ``geometry``, the valid multipolygon of what their rings enclose an odd number of times.

    Rings may cross themselves and each other in any way. Points are taken to the nearest multiple of ``grid``. Null
    rings give null, rings without area an empty multipolygon.
    """
    return polygons.withColumn(geometry, _kernel(lambda s: overlays(s, even_odd=True), grid)(rings))


def buffered(polygons: DataFrame, steps: list[float], rings: str = "rings", geometry: str = "geometry", grid: float = GRID) -> DataFrame:
    """polygons with ``geometry``, grown by each step in turn, or shrunk by a negative one, with round corners.

    Steps (t, -t) close gaps of up to 2 t and fill notches; (-t, t) take off what is thinner. A quarter of a circle is 16
    straight pieces.
    """
    def of(shapes: list[np.ndarray]) -> list[list[Polygon]]:
        found = overlays(shapes, even_odd=True)
        for step in steps:
            found = offsets(found, step / grid)
        return found

    return polygons.withColumn(geometry, _kernel(of, grid)(rings))


# --- unions over a table ---


def _pieces(parts: DataFrame, cell: int, grid: float) -> DataFrame:
    """(key, cx, cy, xs, ys): each ring of each polygon, on the grid and clipped to each cell that the polygon reaches into.

    The rings of a polygon are made valid first, in the polygon's own place, so that they wind once around its inside.
    """
    kinds = {"key": pa.string(), "cx": pa.int64(), "cy": pa.int64(), "xs": pa.list_(pa.int64()), "ys": pa.list_(pa.int64())}

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:  # rings of unequal lengths have no pandas form
        for batch in (b.slice(k, AT_ONCE) for b in batches for k in range(0, b.num_rows, AT_ONCE)):
            out = {c: [] for c in kinds}
            full = [(key, rings) for key, rings in zip(batch["key"].to_pylist(), shapes_of(batch["shape"]), strict=True) if rings]
            origins = [_origin(rings, grid) for _, rings in full]
            found = overlays([_segments(_whole(rings, origin, grid)) for (_, rings), origin in zip(full, origins, strict=True)], even_odd=True)
            for (key, _), origin, polygons in zip(full, origins, found, strict=True):
                move = np.rint(np.array(origin) / grid).astype(np.int64)
                valid = [r + move for p in polygons for r in p]
                if not valid:
                    continue
                every = np.concatenate(valid)
                low, high = every.min(axis=0) // cell, (every.max(axis=0) - 1) // cell
                if (low == high).all():
                    for ring in valid:
                        for c, v in (("key", key), ("cx", int(low[0])), ("cy", int(low[1])), ("xs", ring[:, 0]), ("ys", ring[:, 1])):
                            out[c].append(v)
                    continue
                for cx in range(int(low[0]), int(high[0]) + 1):
                    strip = [clipped(r, cx * cell, int(low[1]) * cell, (cx + 1) * cell, (int(high[1]) + 1) * cell) for r in valid]
                    for cy in range(int(low[1]), int(high[1]) + 1):
                        for ring in strip:
                            if len(ring := clipped(ring, cx * cell, cy * cell, (cx + 1) * cell, (cy + 1) * cell)) > 2:
                                for c, v in (("key", key), ("cx", cx), ("cy", cy), ("xs", ring[:, 0]), ("ys", ring[:, 1])):
                                    out[c].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds[c]) for c, v in out.items()], names=list(kinds))

    return parts.mapInArrow(of, "key string, cx long, cy long, xs array<long>, ys array<long>")


_EDGES = "key string, part string, side string, x0 long, y0 long, x1 long, y1 long"


def _cell_edges(pieces: DataFrame, cell: int) -> DataFrame:
    """The outlines of each cell's union as edges: the part of the cell that they bound, and the cell's side they lie on.

    A cell gathers its rings in portions that are united as they come, so a crowded cell holds its union and one portion.
    """
    portion = 2000

    def of(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, cx, cy = key
        origin = np.array([cx * cell, cy * cell], np.int64)
        held: list[Polygon] = []
        waiting: Rings = []
        for frame in frames:
            for xs, ys in zip(frame["xs"], frame["ys"], strict=True):
                waiting.append(np.stack([xs, ys], axis=1).astype(np.int64) - origin)
                if len(waiting) >= portion:
                    held, waiting = overlay([r for p in held for r in p] + waiting, even_odd=False), []
        if waiting:
            held = overlay([r for p in held for r in p] + waiting, even_odd=False)
        out = []
        for n, polygon in enumerate(held):
            edges = _segments(polygon) + np.tile(origin, 2)
            side = np.full(len(edges), None, object)
            for axis in (0, 1):
                on = (edges[:, axis] == edges[:, axis + 2]) & (edges[:, axis] % cell == 0)
                for k in np.flatnonzero(on):
                    side[k] = f"{'xy'[axis]}:{edges[k, axis] // cell}:{(cx, cy)[1 - axis]}"
            out.append((np.full(len(edges), f"{name}|{cx}|{cy}|{n}", object), side, edges))
        if out:
            part, side, edges = (np.concatenate(x) for x in zip(*out, strict=True))
            yield pd.DataFrame({"key": name, "part": part, "side": side, **{c: edges[:, i] for i, c in enumerate(("x0", "y0", "x1", "y1"))}})

    return pieces.groupBy("key", "cx", "cy").applyInPandas(of, _EDGES)


def _cancelled(sides: DataFrame) -> DataFrame:
    """The edges on a cell's side that only one of its cells has, and rows with ``other``: parts that share some of it."""
    def of(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        e = frame[["x0", "y0", "x1", "y1"]].to_numpy(np.int64)
        axis = 1 if str(key[1]).startswith("x") else 0
        marks = np.unique(e[:, [axis, axis + 2]])
        out = []
        by_place: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for k, (a, b) in enumerate(e[:, [axis, axis + 2]].tolist()):
            lo, hi = np.searchsorted(marks, [min(a, b), max(a, b)])
            for m in range(lo, hi):
                by_place.setdefault((int(marks[m]), int(marks[m + 1])), []).append((k, 1 if a < b else -1))
        part, line = frame["part"].to_numpy(), int(e[0, 1 - axis])
        for (a, b), found in by_place.items():
            if len(found) == 2:
                out.append((key[0], part[found[0][0]], part[found[1][0]], 0, 0, 0, 0))
                continue
            k, sign = found[0]
            ends = [(line, a), (line, b)] if axis else [(a, line), (b, line)]
            (x0, y0), (x1, y1) = ends if sign > 0 else ends[::-1]
            out.append((key[0], part[k], None, x0, y0, x1, y1))
        return pd.DataFrame(out, columns=["key", "part", "other", "x0", "y0", "x1", "y1"])

    return sides.groupBy("key", "side").applyInPandas(of, "key string, part string, other string, x0 long, y0 long, x1 long, y1 long")


def united(polygons: DataFrame, keys: list[str], rings: str = "rings", cell: float = 512.0, grid: float = GRID) -> DataFrame:
    """(keys, label, rings): the union of polygons for each value of keys, a row for each of its parts.

    Any coordinates: points and crossings are taken to multiples of ``grid``. ``cell``, a multiple of it, is the side of
    the squares that are united each in a task; a part's outline is closed in one task, and so are its points in its row.
    Rings are closed, a shell first and then its holes. Rows with a null key are united like those of any other value;
    null rings and rings without area add nothing. ``label`` tells a key's parts apart.
    """
    side = round(cell / grid)
    if side * grid != cell or side > SPAN / 4:
        raise ValueError("cell must be a multiple of grid, of at most 2 ** 27 times")
    name = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    parts = polygons.select(name.alias("key"), F.col(rings).alias("shape")).filter(F.col("shape").isNotNull())
    edges = stored(_cell_edges(_pieces(parts, side, grid), side), "cell-edges")
    shared = stored(_cancelled(edges.filter(F.col("side").isNotNull())), "cell-sides")
    links = shared.filter(F.col("other").isNotNull()).select(F.col("part").alias("a"), F.col("other").alias("b"))
    roots = stored(components(links), "regions")
    left = edges.filter(F.col("side").isNull()).drop("side").unionByName(shared.filter(F.col("other").isNull()).drop("other"))
    whole = left.join(roots, left["part"] == roots["node"], "left").withColumn("region", F.coalesce("root", "part"))

    def closed(frame: pd.DataFrame) -> list[tuple]:
        e = frame[["x0", "y0", "x1", "y1"]].to_numpy(np.int64)
        name, region = frame["key"].iloc[0], frame["region"].iloc[0]
        origin = e[:, :2].min(axis=0)
        found = polygons_of(chained(e - np.tile(origin, 2)))
        shapes = [[_closed(r, tuple((origin * grid).tolist()), grid) for r in p] for p in found]
        return [(name, f"{region}|{n}", rings) for n, rings in enumerate(shapes)]

    out = by_runs(whole.select("key", "region", "x0", "y0", "x1", "y1"), ["key", "region"], closed, f"key string, label string, rings {RINGS}")
    fields = ", ".join(f"{c} {dict(polygons.dtypes)[c]}" for c in keys)
    return out.select(F.from_json("key", fields).alias("k"), "label", "rings").select(*[F.col(f"k.{c}").alias(c) for c in keys], "label", "rings")
