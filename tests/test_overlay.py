"""Overlays against an independent slow version: exact areas by vertical slabs between all crossings."""

import time
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.functions.geometry import polygon_area
from rasterloom.operators import features, overlay, shapes


def slow_area(rings, inside):
    """The area where inside(winding, crossings), by Fractions."""
    edges = []
    for ring in rings:
        p = [(Fraction(float(x)), Fraction(float(y))) for x, y in ring]
        edges += [(a, b) for a, b in zip(p, p[1:] + p[:1], strict=True) if a[0] != b[0]]
    xs = {p[0] for e in edges for p in e}
    for i, ((ax, ay), (bx, by)) in enumerate(edges):
        for (cx, cy), (dx, dy) in edges[:i]:
            cross = (bx - ax) * (dy - cy) - (by - ay) * (dx - cx)
            if cross:
                t = ((cx - ax) * (dy - cy) - (cy - ay) * (dx - cx)) / cross
                if 0 <= t <= 1:
                    xs.add(ax + t * (bx - ax))
    xs, total = sorted(xs), Fraction(0)
    for lo, hi in zip(xs, xs[1:], strict=False):
        at = lambda e, x: e[0][1] + (x - e[0][0]) / (e[1][0] - e[0][0]) * (e[1][1] - e[0][1])
        on = [e for e in edges if min(e[0][0], e[1][0]) <= lo and max(e[0][0], e[1][0]) >= hi]
        on.sort(key=lambda e: at(e, (lo + hi) / 2))
        winding, count = 0, 0
        for low, high in zip(on, on[1:] + on[:1], strict=True):
            winding += 1 if low[1][0] > low[0][0] else -1
            count += 1
            if inside(winding, count) and high is not on[0]:
                total += (at(high, lo) - at(low, lo) + at(high, hi) - at(low, hi)) / 2 * (hi - lo)
    return float(total)


def size(polygons):
    return -sum(overlay.ring_area(r) for p in polygons for r in p)


def odd(winding, count):
    return count % 2 == 1


def star(rng, n, spread):
    return rng.integers(0, spread, (n, 2))


def valid(polygons):
    """Shells run clockwise and holes the other way, no two edges cross or lie on each other, no ring passes a point twice."""
    for polygon in polygons:
        assert overlay.ring_area(polygon[0]) < 0 and all(overlay.ring_area(h) > 0 for h in polygon[1:])
        assert all(len({tuple(p) for p in r.tolist()}) == len(r) for r in polygon)
    edges = overlay._segments([r for p in polygons for r in p])
    cut, forward, backward = overlay.noded(edges)
    assert (forward + backward == 1).all()


@pytest.mark.parametrize("seed", range(25))
def test_random_rings_have_the_exact_area(seed):
    rng = np.random.default_rng(seed)
    rings = [star(rng, rng.integers(3, 9), 1 << 20) for _ in range(rng.integers(1, 4))]
    found = overlay.overlay(rings, even_odd=True)
    valid(found)
    assert size(found) == pytest.approx(slow_area(rings, odd), rel=1e-4)
    found = overlay.overlay(rings, even_odd=False)
    valid(found)
    assert size(found) == pytest.approx(slow_area(rings, lambda w, _: w < 0), rel=1e-4, abs=2e6)


@pytest.mark.parametrize("seed", range(25))
def test_small_grids_with_touching_points_and_equal_edges(seed):
    rng = np.random.default_rng(100 + seed)
    box = lambda x0, y0, x1, y1: np.array([(x0, y0), (x1, y0), (x1, y1), (x0, y1)])
    rings = []
    for _ in range(rng.integers(1, 8)):
        (x0, x1), (y0, y1) = sorted(rng.choice(9, 2, replace=False)), sorted(rng.choice(9, 2, replace=False))
        rings.append(box(x0, y0, x1, y1)[:: rng.choice([1, -1])])
    for rule, even_odd in ((odd, True), (lambda w, _: w < 0, False)):
        found = overlay.overlay(rings, even_odd)
        valid(found)
        assert size(found) == slow_area(rings, rule)


def test_known_shapes():
    box = lambda x0, y0, x1, y1: [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    area = lambda parts: sum(abs(shapes.area(p[0])) - sum(abs(shapes.area(r)) for r in p[1:]) for p in parts)
    assert area(shapes.repair([box(0, 0, 4, 4), box(2, 2, 6, 6)])) == 24
    assert area(shapes.repair([box(0, 0, 10, 10), box(8, 2, 12, 4)])) == 100
    touching = shapes.repair([box(0, 0, 10, 10), [(0, 5), (4, 3), (4, 7), (0, 5)]])
    assert len(touching) == 1 and len(touching[0]) == 2  # a hole that touches its shell stays a hole
    islands = shapes.repair([box(0, 0, 9, 9), box(1, 1, 8, 8), box(2, 2, 7, 7), box(3, 3, 6, 6)])
    assert sorted(len(p) for p in islands) == [2, 2] and area(islands) == 81 - 49 + 25 - 9


def test_three_thousand_points_take_under_a_second():
    angle = np.linspace(0, 2 * np.pi, 3001)[:-1]
    rng = np.random.default_rng(1)
    ring = np.stack([np.cos(angle), np.sin(angle)], 1) * (1 + 0.3 * np.sin(17 * angle))[:, None] * 1000 + rng.normal(size=(3000, 2)) * 3
    start = time.perf_counter()
    parts = shapes.repair([[tuple(p) for p in ring.tolist()]])
    assert time.perf_counter() - start < 1 and len(parts) > 10


def test_buffers():
    box = lambda x0, y0, x1, y1: np.array([(x0, y0), (x0, y1), (x1, y1), (x1, y0)], np.int64)
    one = overlay.overlay([box(0, 0, 10_000, 10_000)], False)
    grown = overlay.offset(one, 1000)
    assert size(grown) == pytest.approx(1e8 + 4e7 + np.pi * 1e6, rel=1e-4) and size(overlay.offset(grown, -1000)) == pytest.approx(1e8, rel=1e-5)
    assert size(overlay.offset(one, -1000)) == 64e6 and overlay.offset(one, -5000) == []
    for gap, parts in ((1999, 1), (2000, 1), (2002, 2)):
        two = overlay.overlay([box(0, 0, 10_000, 10_000), box(10_000 + gap, 0, 20_000 + gap, 10_000)], False)
        assert len(overlay.offset(overlay.offset(two, 1000), -1000)) == parts
    holed = overlay.overlay([box(0, 0, 10_000, 10_000), box(4000, 4000, 5000, 5000)], True)
    assert [len(p) for p in overlay.offset(holed, 500)] == [1] and size(overlay.offset(overlay.offset(holed, 600), -600)) == pytest.approx(1e8, rel=1e-5)
    assert [len(p) for p in overlay.offset(holed, -500)] == [2]
    rng = np.random.default_rng(4)
    for _ in range(5):  # every point of what is grown lies within the distance, and none beyond
        shape = overlay.overlay([rng.integers(0, 100_000, (7, 2))], True)
        edges = overlay._segments([r for p in shape for r in p]).astype(float)
        grown = overlay.offset(shape, 4000)
        for point in rng.integers(-6000, 106_000, (200, 2)).astype(float):
            a, d = edges[:, :2], edges[:, 2:] - edges[:, :2]
            t = np.clip(((point - a) * d).sum(1) / (d * d).sum(1), 0, 1)
            far = np.hypot(*(a + t[:, None] * d - point).T).min()
            holds = lambda ps: sum(overlay._holds(r, int(2 * point[0]), int(2 * point[1])) for p in ps for r in p) % 2 == 1
            if abs(far - 4000) > 30:
                assert holds(grown) == (holds(shape) or far < 4000)


def test_shrinking_what_was_grown_cuts_few_segments(monkeypatch):
    box = lambda x0, y0, x1, y1: np.array([(x0, y0), (x0, y1), (x1, y1), (x1, y0)], np.int64)
    grown = overlay.offset(overlay.overlay([box(0, 0, 9000, 9000), box(9512, 0, 18_512, 9000)], False), 768)
    cut, noded = [], overlay.noded
    monkeypatch.setattr(overlay, "noded", lambda *a, **k: cut.append(noded(*a, **k)) or cut[-1])
    (one,) = overlay.offset(grown, -768)
    assert size([one]) == pytest.approx(18_512 * 9000, rel=1e-3) and max(len(s) for s, _, _ in cut) < 10 * sum(map(len, grown[0]))


def test_cut_rectangles_give_the_same_offsets(monkeypatch):
    rng, cut_chains = np.random.default_rng(12), overlay._cut_chains
    perimeter = lambda ps: sum(np.hypot(*(r - np.roll(r, 1, axis=0)).T).sum() for p in ps for r in p)

    def both(shape, distance):
        found = []
        for of in (cut_chains, lambda *_: {}):
            monkeypatch.setattr(overlay, "_cut_chains", of)
            found.append(overlay.offset(shape, distance))
        assert len(found[0]) == len(found[1]) and size(found[0]) == pytest.approx(size(found[1]), abs=100 + perimeter(found[1]))
        return found[0]

    cut = 0
    for k in range(9):
        if k % 3 == 0:
            shape = overlay.overlay([rng.integers(0, 20_000, (int(rng.integers(3, 8)), 2))], True)
        elif k % 3 == 1:
            angle = np.sort(rng.random(30)) * 2 * np.pi
            ring = np.stack([np.cos(angle), np.sin(angle)], 1) * (0.6 + 0.4 * rng.random((30, 1))) * 8000 + 9000
            shape = overlay.overlay([np.rint(ring).astype(np.int64)], True)
        else:
            corners = rng.integers(0, 9000, (3, 2))
            shape = overlay.overlay([np.array([(x, y), (x, y + 4000), (x + 5000, y + 4000), (x + 5000, y)]) for x, y in corners], False)
        distance = float(rng.integers(100, 1200))
        grown = both(shape, distance)
        both(grown, -distance)
        both(grown, -1.7 * distance)
        if less := both(shape, -distance):
            both(less, distance)
        cut += sum(bool(cut_chains(*parts)) for parts in _chains(grown, distance))
    assert cut >= 5


def _chains(polygons, distance):
    for ring in (r[::-1] for p in polygons for r in p):
        ahead = np.roll(ring, -1, axis=0) - ring.astype(float)
        length = np.hypot(ahead[:, 0], ahead[:, 1])
        up = np.stack([-ahead[:, 1], ahead[:, 0]], axis=1) / length[:, None]
        before = np.roll(up, 1, axis=0)
        yield ring.astype(float), ahead / length[:, None], length, up, np.arctan2(before[:, 0] * up[:, 1] - before[:, 1] * up[:, 0], (before * up).sum(axis=1)), distance


def rows_of(spark, shapes_by_key):
    point = lambda p: {"x": float(p[0]), "y": float(p[1])}
    rows = [(k, [[point(p) for p in ring] for ring in rings]) for k, rings in shapes_by_key]
    return spark.createDataFrame(rows, f"k string, rings {overlay.RINGS}")


def test_unions_over_cells_equal_one_kernel_and_the_slow_version(spark):
    rng = np.random.default_rng(7)
    made, by_key = [], {}
    for i in range(60):
        center, r = rng.random(2) * 200 - 100, rng.random() * 40 + 5
        angle = np.sort(rng.random(rng.integers(3, 7))) * 2 * np.pi
        ring = np.round((center + np.stack([np.cos(angle), np.sin(angle)], 1) * r) * 1024) / 1024
        key = [None, "a", "b"][i % 3]
        rings = [ring[:: rng.choice([1, -1])]]
        made.append((key, rings))
        by_key.setdefault(key, []).append(overlay.overlay([np.rint(ring * 1024).astype(np.int64) + (1 << 20)], True))
    made += made[:5] * 4  # repeats change nothing
    out = overlay.united(rows_of(spark, made), ["k"], cell=32.0).withColumn("area", polygon_area(F.col("rings"))).collect()
    for key, polygons in by_key.items():
        rings = [r for ps in polygons for p in ps for r in p]
        whole = overlay.overlay(rings, even_odd=False)
        mine = [r for r in out if r.k == key]
        assert sorted(r.area for r in mine) == pytest.approx(sorted(size([p]) / 1024**2 for p in whole), abs=0.3)
        assert sum(r.area for r in mine) == pytest.approx(slow_area(rings, lambda w, _: w < 0) / 1024**2, abs=0.5)
        assert len({r.label for r in mine}) == len(mine) == len(whole)


def test_union_edges(spark):
    box = lambda x, y, s: [(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]
    rows = rows_of(spark, [("k", [box(0, 0, 2.5)]), ("k", [box(1, 1, 2.5)]), ("k", []), ("k", [[(0, 0), (1, 1)]])])
    (one,) = overlay.united(rows, ["k"], cell=1.0).collect()
    assert len(one.rings) == 1 and abs(shapes.area([(p.x, p.y) for p in one.rings[0]])) == 2 * 6.25 - 2.25 and len(one.rings[0]) == 9
    ring = rows_of(spark, [("k", [box(0, 0, 8), box(3, 3, 2)])])
    (one,) = overlay.united(ring, ["k"], cell=4.0).collect()  # the hole lies in four cells
    assert len(one.rings) == 2
    triangle = [(1, 1), (2, 1), (2, 2), (1, 1)]
    holes = rows_of(spark, [("k", [box(0, 0, 8), triangle]), ("k", [box(20, 0, 8), box(22, 2, 1), [(24, 4), (25, 4), (25, 5), (24, 4)]])])
    assert sorted(len(r.rings) for r in overlay.united(holes, ["k"], cell=4.0).collect()) == [2, 3]  # rings of unequal lengths
    assert overlay.united(rows.limit(0), ["k"]).collect() == []
    with pytest.raises(ValueError):
        overlay.united(rows, ["k"], cell=0.3)


def test_dissolve_parts_unites(spark):
    box = lambda x, y, s: [[{"x": float(a), "y": float(b)} for a, b in ((x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y))]]
    rows = [("t", "road", None, [box(0, 0, 2)]), ("t", "road", 0.5, [box(1.25, 1.25, 2), box(9, 9, 1)]), ("t", None, None, [box(0, 0, 1)]), ("u", "road", None, [])]
    out = {r.source_tile: r for r in features.dissolve_parts(spark.createDataFrame(rows, features.FEATURE_SCHEMA), cell=1.0).collect()}
    assert len(out["t"].geometry) == 2 and out["t"].confidence == 0.5 and out["u"].geometry == []
    total = sum(abs(shapes.area([(p.x, p.y) for p in part[0]])) for part in out["t"].geometry)
    assert total == 4 + 4 - 0.75**2 + 1


def test_repaired_and_buffered_columns(spark):
    box = lambda x, y, s: [(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]
    rows = rows_of(spark, [("a", [box(0, 0, 4), box(2, 2, 4)]), ("b", []), ("c", [[(0, 0), (1, 1)]])]).union(spark.sql(f"SELECT 'd', CAST(NULL AS {overlay.RINGS})"))
    out = {r.k: r.geometry for r in overlay.repaired(rows).collect()}
    assert len(out["a"]) == 2 and out["b"] == out["c"] == [] and out["d"] is None
    out = {r.k: r.geometry for r in overlay.buffered(rows, [1.0, -1.0]).collect()}
    assert len(out["a"]) == 1 and out["b"] == [] and out["d"] is None


def test_shapes_side_by_side_are_as_alone():
    rng = np.random.default_rng(8)
    shapes_ = [[star(rng, int(rng.integers(3, 9)), 4000) * int(rng.integers(1, 30)) for _ in range(int(rng.integers(1, 4)))] for _ in range(25)] + [[]]
    same = lambda a, b: len(a) == len(b) and all(len(p) == len(q) and all(map(np.array_equal, p, q)) for p, q in zip(a, b, strict=True))
    for even_odd in (True, False):
        alone = [overlay.overlay(r, even_odd) for r in shapes_]
        for most in (1, 100, 1 << 14):
            together = overlay.overlays([overlay._segments(r) for r in shapes_], even_odd, most)
            assert all(map(same, alone, together))
    for step in (300.0, -300.0):
        assert all(map(same, [overlay.offset(x, step) for x in alone], overlay.offsets(alone, step)))


def test_rings_come_from_arrow_and_go_back():
    import pyarrow as pa

    p = lambda *xy: [{"x": float(x), "y": float(y)} for x, y in xy]
    ring, other = p((0, 0), (0, 2), (2, 2)), p((5, 5), (5, 7), (9, 9), (9, 5))
    kind = pa.list_(pa.list_(overlay._POINT))
    column = pa.array([[other], None, [], [ring, None, [], other], [ring]], kind)
    for part in (column, column.slice(1), column.slice(3, 1)):
        read = overlay.shapes_of(part)
        assert [None if s is None else [r.tolist() for r in s] for s in read] == [
            None if s is None else [[[q["x"], q["y"]] for q in r] for r in s if r] for s in part.to_pylist()]
    out = overlay.multipolygons([None if s is None else [s] for s in overlay.shapes_of(column)])
    assert out.type == pa.list_(kind) and out.to_pylist() == [[[other]], None, [[]], [[ring, other]], [[ring]]]


def test_a_small_file_of_shapes_is_worked_on_by_many_tasks(spark):
    from rasterloom.plans.shape_queries import closed_gaps

    out = closed_gaps(spark, "/root/testdata/sf0.001")
    assert out.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
