"""Simplifying that keeps topology, and regularising as one kernel against the column expressions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.functions import geometry
from rasterloom.functions.geometry import axis_snapped, centroid, rotated
from rasterloom.operators import overlay, shapes
from rasterloom.plans import vectorizing

RINGS = "array<array<struct<x:double,y:double>>>"


def simple(rings):
    """Whether no two segments of the rings cross or lie on each other, on a fine grid."""
    whole = [np.rint(np.asarray(r[:-1]) * 4096).astype(np.int64) for r in rings]
    low = np.concatenate(whole).min(axis=0)
    edges = overlay._segments([r - low for r in whole])
    cut, forward, backward = overlay.noded(edges)
    return len(cut) == len(edges) and (forward + backward == 1).all()


def test_a_hole_in_a_dent_stays_inside():
    shell = [(0.0, 0.0), (40.0, 0.0), (50.0, -6.0), (60.0, 0.0), (100.0, 0.0), (100.0, 50.0), (0.0, 50.0), (0.0, 0.0)]
    hole = [(48.0, -3.0), (52.0, -3.0), (50.0, -1.0), (48.0, -3.0)]
    out = shapes.simplify([shell, hole], 7)
    assert (50.0, -6.0) in out[0] and out[1] == hole and simple(out)
    assert (50.0, -6.0) not in shapes.simplify([shell], 7)[0]


def test_lines_do_not_cross_other_rings():
    shell = [(0.0, 0.0), (30.0, 0.0), (30.0, 30.0), (0.0, 30.0), (0.0, 0.0)]
    comb = [(2.0, 2.0)] + [(2.0 + k, 2.0 + 3 * (k % 2)) for k in range(1, 20)] + [(21.0, 2.0), (21.0, 1.0), (2.0, 1.0), (2.0, 2.0)]
    tooth = [(3.9, 4.0), (4.1, 4.0), (4.0, 3.0), (3.9, 4.0)]
    assert simple([shell, comb, tooth])
    for tolerance in (0.5, 1, 2, 4, 8):
        assert simple(shapes.simplify([shell, comb, tooth], tolerance))


@pytest.mark.parametrize("seed", range(12))
def test_random_polygons_keep_rings_apart_and_near(seed):
    rng = np.random.default_rng(seed)
    angle = np.linspace(0, 2 * np.pi, 201)[:-1]
    wave = lambda r, jitter: [(float(x), float(y)) for x, y in np.round(np.stack([np.cos(angle), np.sin(angle)], 1) * (r + rng.normal(size=(200, 1)) * jitter) * 64) / 64]
    rings = [wave(100, 3), wave(80, 3), ]
    rings = [[*r, r[0]] for r in rings]
    if not simple(rings):
        return
    for tolerance in (1.0, 5.0, 20.0):
        out = shapes.simplify(rings, tolerance)
        assert simple(out) and sum(map(len, out)) < sum(map(len, rings))
        assert all(shapes._holds(np.asarray(out[0][:-1]), np.asarray(out[1][:-1])))
        for new, old in zip(out, rings, strict=True):
            assert set(new) <= set(old)


def test_regularising_equals_the_column_expressions(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(60):
        w, h, turn = rng.integers(5, 30), rng.integers(5, 30), rng.random() * 90
        p = [(0, 0), (w / 2, rng.random() * 0.4), (w, 0), (w, h), (0, h), (0, 0)]
        c, s = np.cos(np.radians(turn)), np.sin(np.radians(turn))
        rows.append((k, [[{"x": float(x * c - y * s), "y": float(x * s + y * c)} for x, y in p]]))
    df = spark.createDataFrame(rows, f"k int, rings {RINGS}")
    got = {r.k: r.rings[0] for r in shapes.regularized(df, 0.0, 12.0, 0.0, 9.0).collect()}
    angles = {k: shapes.dominant_angle([(p["x"], p["y"]) for p in rings[0]]) for k, rings in rows}
    ring = F.element_at("rings", 1)
    given = df.join(spark.createDataFrame(list(angles.items()), "k int, angle double"), "k").withColumn("middle", centroid(ring))
    flat = given.withColumn("flat", axis_snapped(rotated(ring, -F.col("angle"), F.col("middle")), 12.0)).withColumn("about", centroid(F.col("flat")))
    for r in flat.select("k", rotated(F.col("flat"), F.col("angle"), F.col("about")).alias("ring")).collect():
        assert len(r.ring) == len(got[r.k])
        assert np.abs(np.array(r.ring) - np.array(got[r.k])).max() < 1e-6


def test_shapes_without_area_stay(spark):
    rows = [(0, []), (1, None), (2, [[{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 1.0}, {"x": 0.0, "y": 0.0}]]), (3, [[{"x": float(x), "y": 0.0} for x in (0, 1, 2, 0)]])]
    df = spark.createDataFrame(rows, f"k int, rings {RINGS}")
    for out in (shapes.regularized(df, 0.1), shapes.simplified(df, 0.1)):
        assert {r.k: None if r.rings is None else [[(p.x, p.y) for p in q] for q in r.rings] for r in out.collect()}.keys() == {0, 1, 2, 3}


def test_shape_columns_hold_few_rows_at_a_time(spark, monkeypatch):
    import pyarrow as pa

    p = [{"x": 0.0, "y": 0.0}, {"x": 0.0, "y": 2.0}, {"x": 2.0, "y": 2.0}, {"x": 0.0, "y": 0.0}]
    rows = [[p], None, [], [p, []], [p, p]] * 300
    kind = pa.list_(pa.list_(shapes.overlay._POINT))
    seen = []

    def some(part):
        seen.append(len(part))
        held = shapes.overlay.shapes_of(part, whole=True)
        assert sum(len(r) for s in held if s for r in s) <= 16 * len(part)
        return shapes.overlay.many_rings(held)

    (out,) = shapes._sliced(some)(iter([pa.array(rows, kind)]))
    assert out.to_pylist() == rows and max(seen) <= shapes.overlay.AT_ONCE and sum(seen) == len(rows)
    kept = spark.createDataFrame([(1, [p]), (2, None), (3, [p, p])], f"k int, rings {shapes.RINGS}").withColumn("rings", shapes._each(lambda r: r)("rings"))
    assert [r.rings if r.rings is None else len(r.rings) for r in kept.orderBy("k").collect()] == [1, None, 2]
    parts = spark.createDataFrame([(1, [[p], [p]]), (2, None), (3, [])], f"k int, g array<{shapes.RINGS}>").withColumn("g", shapes.each_part(lambda r: r)("g"))
    assert [r.g if r.g is None else len(r.g) for r in parts.orderBy("k").collect()] == [2, None, 0]


def test_regions_are_closed_in_many_tasks(spark):
    rows = [(None if k % 5 == 0 else "a", k, 2 * k, c) for k in range(200) for c in range(1 + k % 3)]
    out = shapes.merged_polygons(spark.createDataFrame(rows, "class_name string, label long, gr long, gc long"))
    got = out.select("class_name", "label", F.size("rings").alias("n"), F.spark_partition_id().alias("task"), geometry.polygon_area(F.col("rings")).alias("area")).collect()
    assert {(r.class_name, r.label, r.n, r.area) for r in got} == {(None if k % 5 == 0 else "a", k, 1, 1.0 + k % 3) for k in range(200)}
    assert len(got) == 200 and len({r.task for r in got}) > 1


def test_runs_of_rows_go_over_batches(spark):
    rows = [(None if k == 3 else f"k{k}", n, n * k) for k in range(9) for n in range(1 + 2 * k)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in (1, 4, 10_000):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            out = overlay.by_runs(spark.createDataFrame(rows, "k string, n long, v long"), ["k"], lambda x: [(x.k.iloc[0], len(x), int(x.v.sum()))], "k string, n long, v long")
            assert sorted((r.k or "", r.n, r.v) for r in out.collect()) == sorted(("" if k == 3 else f"k{k}", 1 + 2 * k, k * k * (1 + 2 * k)) for k in range(9))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_tiles_become_valid_polygons_in_many_tasks(spark):
    rows = [(t, r, c, int((r + t) % 4 < 2)) for t in range(40) for r in range(8) for c in range(8)]
    masks = spark.createDataFrame(rows, "tile_id int, r int, c int, mask int")
    polygons = vectorizing.mask_polygons(masks, vectorizing.Options())
    assert polygons.select(F.spark_partition_id().alias("task")).distinct().count() > 1
    got = vectorizing.vectorized(polygons.withColumn("class_name", F.lit("a")), vectorizing.Options(rectangularize=0.9))
    area = F.aggregate("geometry", F.lit(0.0), lambda s, p: s + geometry.polygon_area(p))
    assert got.groupBy().agg(F.sum(area)).first()[0] == sum(m for *_, m in rows)
