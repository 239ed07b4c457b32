"""The scanline rasteriser and the spatial join against plain versions."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rasterloom.functions.geometry import box_meets_polygon, contains
from rasterloom.operators import labels

RINGS = "array<array<struct<x:double,y:double>>>"


def polygons(spark, n=40, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        rings = []
        for _ in range(rng.integers(1, 3)):
            p = rng.integers(-20, 120, (rng.integers(3, 7), 2)) / rng.choice([1, 2, 4])
            p = p if k % 2 else p + rng.random(2)
            rings.append([{"x": float(x), "y": float(y)} for x, y in [*p, p[0]]])
        rows.append((k, rings))
    return spark.createDataFrame([*rows, (n, []), (n + 1, None)], f"k int, rings {RINGS}")


@pytest.mark.parametrize("all_touched", [False, True])
def test_scanlines_burn_the_cells_that_tests_of_each_cell_find(spark, all_touched):
    shapes = polygons(spark)
    got = {tuple(r) for r in labels.covered_cells(shapes, ["k"], 50, 40, all_touched).collect()}
    cells = spark.range(40).select(F.col("id").alias("r")).crossJoin(spark.range(50).select(F.col("id").alias("c")))
    every = shapes.filter("size(rings) > 0").crossJoin(cells)
    if all_touched:
        cell = F.struct(*[v.cast("double").alias(n) for n, v in (("west", F.col("c")), ("south", F.col("r")), ("east", F.col("c") + 1), ("north", F.col("r") + 1))])
        inside = F.transform("rings", lambda ring: contains(ring, F.col("c") + 0.5, F.col("r") + 0.5).cast("int"))
        touched = F.exists("rings", lambda ring: box_meets_polygon(cell, F.array(ring)) & ~(contains(ring, F.col("c").cast("double"), F.col("r").cast("double")) & contains(ring, F.col("c") + 1.0, F.col("r") + 1.0)))
        hit = (F.aggregate(inside, F.lit(0), lambda s, k: s + k) % 2 == 1) | touched
        want = {tuple(r) for r in every.filter(hit).select("k", "r", "c").collect()}
        assert len(got ^ want) <= 0.01 * len(want)  # cells in a hole's thin corner are told apart by corners alone above
        crossed = every.filter(F.exists("rings", lambda ring: F.exists(F.zip_with(F.slice(ring, F.lit(1), F.size(ring) - 1), F.slice(ring, F.lit(2), F.size(ring) - 1), lambda p, q: _meets(p, q, cell)), lambda h: h)))
        assert {tuple(r) for r in crossed.select("k", "r", "c").collect()} <= got
    else:
        inside = F.transform("rings", lambda ring: contains(ring, F.col("c") + 0.5, F.col("r") + 0.5).cast("int"))
        want = {tuple(r) for r in every.filter(F.aggregate(inside, F.lit(0), lambda s, k: s + k) % 2 == 1).select("k", "r", "c").collect()}
        assert got == want


def _meets(p, q, cell):
    from rasterloom.functions.geometry import segment_meets_box

    return segment_meets_box(p, q, cell)


def test_work_follows_vertices_and_runs():
    side = 100_000
    ring = [{"x": 0.0, "y": 0.0}, {"x": float(side), "y": 0.0}, {"x": float(side), "y": float(side)}, {"x": 0.0, "y": float(side)}, {"x": 0.0, "y": 0.0}]
    runs = labels.scanline_runs(pa.array([[ring], [], None], pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))), None, None, False)
    assert [len(r) for r in runs.to_pylist()] == [side, 0, 0]  # ten billion cells, a run each row
    assert runs[0][0].as_py() == {"r": 0, "c0": 0, "c1": side - 1}


def test_a_crowded_cell_is_cut_up_and_no_pair_is_lost(spark):
    rng = np.random.default_rng(2)
    boxes = [(k, 100, 100, 110, 110) if k % 2 else (k, *(p := rng.integers(0, 2000, 2).tolist()), p[0] + 30, p[1] + 30) for k in range(4000)]
    wins = [(k, x, y, 128, 128) for k, (x, y) in enumerate((x, y) for x in range(0, 2000, 96) for y in range(0, 2000, 96))]
    left = spark.createDataFrame(wins, "tile_idx int, col_off int, row_off int, win_width int, win_height int")
    right = spark.createDataFrame(boxes, "label_id int, x0 int, y0 int, x1 int, y1 int")
    got = labels.tile_label_join(left, right, 256, most=50)
    assert set(got.columns) == set(left.columns) | set(right.columns)
    found = [(r.tile_idx, r.label_id) for r in got.collect()]
    want = {(t, k) for t, x, y, w, h in wins for k, x0, y0, x1, y1 in boxes if x0 <= x + w and x1 >= x and y0 <= y + h and y1 >= y}
    assert len(found) == len(set(found)) and set(found) == want
    sides = labels._in_cells(
        left.selectExpr("*", "col_off _l0", "row_off _t0", "col_off + 128 _l1", "row_off + 128 _t1", "monotonically_increasing_id() _salt"),
        right.selectExpr("*", "x0 _l0", "y0 _t0", "x1 _l1", "y1 _t1", "monotonically_increasing_id() _salt"), 256, 50,
    )
    sizes = sorted(r["count"] for r in sides[1].groupBy("_cx", "_cy", "_i", "_j").count().collect())
    assert sizes[-1] <= 3 * sizes[len(sizes) // 2]  # half of all labels lie in one place
