import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.functions import crs, geometry
from rasterloom.operators import features, inference, labels, morphology, pixels, shapes, windows


def pixel_rows(spark, grid, tile=0, name="mask"):
    rows = [(tile, r, c, grid[r][c]) for r in range(len(grid)) for c in range(len(grid[0]))]
    return spark.createDataFrame(rows, f"tile_id int, r int, c int, {name} {'int' if name == 'mask' else 'double'}")


def as_grid(df, name="mask"):
    rows = df.collect()
    out = np.zeros((max(r.r for r in rows) + 1, max(r.c for r in rows) + 1))
    for r in rows:
        out[r.r, r.c] = r[name]
    return out


def scenes(spark, *rows):
    return spark.createDataFrame(rows, "scene_id int, width int, height int, tile_size int, overlap int")


def test_window_grid_shifts_the_last_window_to_the_edge(spark):
    rows = windows.window_grid(scenes(spark, (1, 10, 6, 4, 1))).orderBy("tile_idx").collect()
    assert [(r.col_off, r.row_off) for r in rows] == [(x, y) for y in (0, 2) for x in (0, 3, 6)]
    assert {(r.win_width, r.win_height) for r in rows} == {(4, 4)}


def test_window_grid_of_a_small_scene_and_bad_sizes(spark):
    (one,) = windows.window_grid(scenes(spark, (1, 3, 2, 4, 0))).collect()
    assert (one.win_width, one.win_height) == (3, 2)
    with pytest.raises(Exception, match="tile_size"):
        windows.window_grid(scenes(spark, (1, 9, 9, 4, 4))).collect()


def test_tiles_are_numbered_after_the_area_filter(spark):
    grid = windows.window_grid(scenes(spark, (1, 8, 4, 4, 0)))
    kept = windows.renumbered(windows.touching(grid, [(5, 0, 7, 1)])).collect()
    assert [(r.tile_idx, r.col_off) for r in kept] == [(0, 4)]
    assert windows.touching(grid, [(4, 0, 4, 0)]).count() == 2  # a shared edge counts


def test_cleanup_fills_a_hole_and_drops_a_speck(spark):
    grid = np.zeros((8, 8), int)
    grid[1:6, 1:6] = 1
    grid[3, 3], grid[7, 7] = 0, 1
    out = as_grid(morphology.cleanup(pixel_rows(spark, grid.tolist()), fill_holes=2, remove_objects=2))
    assert out[3, 3] == 1 and out[7, 7] == 0 and out.sum() == 25


def test_closing_empties_the_border(spark):
    full = pixel_rows(spark, [[1] * 6] * 6)
    assert as_grid(morphology.cleanup(full, close_pixels=1)).sum() == 16


def test_a_small_object_without_a_large_neighbour_stays():
    grid = np.array([[1, 0, 1]])
    assert (morphology.sieve_grid(grid, 2, (0, 1)) == grid).all()


def test_connectivity(spark):
    diagonal = pixel_rows(spark, [[1, 0], [0, 1]])
    assert morphology.tile_components(diagonal, 4).select("label").distinct().count() == 2
    assert morphology.tile_components(diagonal, 8).select("label").distinct().count() == 1


def test_mosaic_components_cross_blocks(spark):
    rng = random.Random(3)
    grid = np.array([[rng.random() < 0.55 for _ in range(30)] for _ in range(20)]).astype(int)
    mask = spark.createDataFrame([(int(r), int(c)) for r, c in zip(*np.nonzero(grid), strict=True)], "gr long, gc long")
    got = {(r.gr, r.gc): r.label for r in morphology.mosaic_components(mask, 7).collect()}
    want = morphology.label_grid(grid, 4)
    pairs = {(got[r, c], want[r, c]) for r, c in got}
    assert len(got) == grid.sum() and len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_overlapping_probabilities_average_in_single_precision(spark):
    rows = [(r, c, 0.2) for r in range(4) for c in range(4)] + [(r, c + 2, 0.8) for r in range(4) for c in range(4)]
    mean = pixels.overlap_mean(spark.createDataFrame(rows, "gr int, gc int, p double"))
    ones = mean.withColumn("mask", pixels.thresholded(F.col("p"), 0.5)).groupBy("gc").agg(F.sum("mask").alias("n")).collect()
    assert {r.gc: r.n for r in ones} == {0: 0, 1: 0, 2: 4, 3: 4, 4: 4, 5: 4}


def test_flips_undo_themselves(spark):
    values = pixel_rows(spark, [[0.0, 0.1, 0.2], [0.3, 0.4, 0.5]], name="v")
    out = pixels.flip_mean(values, lambda df: df.withColumn("p", F.col("v")), ["none", "HFLIP", "vflip", " hvflip"])
    assert np.allclose(as_grid(out, "p"), [[0.0, 0.1, 0.2], [0.3, 0.4, 0.5]])
    with pytest.raises(ValueError, match="turn"):
        pixels.augmentations(["turn"])


def test_threshold_tags_round_half_to_even_and_collisions_fail(spark):
    rows = spark.createDataFrame([(0.285,), (0.575,), (0.5,)], "t double")
    assert [r[0] for r in rows.select(pixels.threshold_tag(F.col("t"))).collect()] == ["t028", "t057", "t050"]
    with pytest.raises(ValueError, match="share"):
        pixels.sweep(rows, [0.251, 0.254])


def test_scale_leaves_nan_out_of_the_largest(spark):
    rows = spark.createDataFrame([(0, 0, 0, float("nan")), (0, 0, 1, 200.0), (1, 0, 0, 0.5), (2, 0, 0, 1000.0)], "tile_id int, r int, c int, v double")
    got = {(r.tile_id, r.c): r.s for r in rows.select("tile_id", "c", pixels.imagery_scale(F.col("v")).alias("s")).collect()}
    assert got[0, 1] == 200 / 255 and got[1, 0] == 0.5 and got[2, 0] == 1.0 and math.isnan(got[0, 0])


def test_resizing_by_sql_and_by_kernel_agree(spark):
    grid = np.arange(20, dtype=float).reshape(4, 5) ** 1.5
    got = as_grid(pixels.resize_bilinear(pixel_rows(spark, grid.tolist(), name="v"), 7, 9), "v")
    assert np.allclose(got, inference.resized(grid, 7, 9))
    near = as_grid(pixels.resize_nearest(pixel_rows(spark, grid.tolist(), name="v"), 1, 3), "v")
    assert near.tolist() == [[grid[0, 0], grid[0, 2], grid[0, 4]]]


def test_inference_over_sizes_and_flips(spark):
    tile = np.stack([np.full((4, 4), v, np.float32) for v in (255, 128, 0)])
    tiles = spark.createDataFrame([("t", 4, 4, [b.ravel().tolist() for b in tile])], "tile_id string, height int, width int, bands array<array<float>>")
    seen = inference.infer(tiles, lambda x: x.mean(axis=1), [2, 4], ["none", "hflip"]).first()
    assert (seen.height, seen.width) == (4, 4) and np.allclose(seen.p, 383 / 255 / 3, atol=1e-6)
    assert inference.backend(None, "a.keras") == "keras" and inference.backend("", "a.pth") == "onnx"
    assert inference.input_sizes("512, 256,512") == [512, 256]
    with pytest.raises(ValueError):
        inference.plane(np.zeros((5, 4, 3)))
    long = inference.long_form(inference.infer(tiles, lambda x: x[:, 0] * 4 - 2)).first()
    assert abs(long.p - 1 / (1 + math.exp(-2))) < 1e-6  # the sigmoid gate


def test_polygons_have_holes_and_diagonals_stay_apart(spark):
    ring = [[1, 1, 1], [1, 0, 1], [1, 1, 1]]
    (one,) = shapes.polygonize(morphology.tile_components(pixel_rows(spark, ring), 4)).select("rings", geometry.polygon_area(F.col("rings")).alias("area")).collect()
    assert one.area == 8 and len(one.rings) == 2
    both = shapes.polygonize(morphology.tile_components(pixel_rows(spark, [[1, 0], [0, 1]]), 4))
    assert both.count() == 2
    touching = shapes.trace(np.array([[1, 1, 0], [1, 0, 1], [1, 1, 1]]))[1]
    assert sum(shapes.area(r) for r in touching) in (7, -7)


def test_traced_area_equals_pixels_on_random_masks():
    rng = np.random.default_rng(4)
    for _ in range(30):
        grid = (rng.random((9, 11)) < 0.6).astype(int)
        label = np.where(grid == 1, morphology.label_grid(grid, 4) + 1, 0)
        for k, rings in shapes.trace(label).items():
            assert abs(sum(shapes.area(r) for r in rings)) == (label == k).sum()


def test_rectangles():
    square = np.ones((6, 6), int)
    for r, c in ((0, 0), (0, 5), (5, 0), (5, 5)):
        square[r, c] = 0
    (rings,) = shapes.trace(square).values()
    (box,) = shapes.rectangularize(rings, 0.85)
    assert len(box) == 5 and abs(abs(shapes.area(box)) - 36) < 1e-9
    ell = np.zeros((9, 9), int)
    ell[:, :2] = 1
    ell[7:, 2:] = 1
    (rings,) = shapes.trace(ell).values()
    (kept,) = shapes.rectangularize(rings, 0.9)
    assert abs(shapes.area(kept)) == ell.sum() and len(kept) > 5


def test_regularized_keeps_a_nearly_straight_polygon(spark):
    ring = [(0.0, 0.0), (10.0, 0.6), (10.4, 5.0), (6.0, 5.2), (5.8, 9.0), (0.2, 9.1), (0.0, 0.0)]
    rows = spark.createDataFrame([(1, [[{"x": x, "y": y} for x, y in ring]])], f"id int, rings {shapes.RINGS}")
    out = shapes.regularized(rows, 0.0, 10.0).select("rings", geometry.polygon_area(F.col("rings")).alias("area")).first()
    assert out.area > 0 and len(out.rings[0]) > 5 and 0.7 <= out.area / abs(shapes.area(ring)) <= 1.35


def test_simplify_and_smooth():
    wavy = [(float(x), 0.1 * (x % 2)) for x in range(11)] + [(10.0, 5.0), (0.0, 5.0), (0.0, 0.0)]
    (out,) = shapes.simplify([wavy], 0.5)
    assert len(out) == 5
    gap = np.ones((5, 7), int)
    gap[2, 3] = 0
    assert shapes.smooth(gap, 1).sum() == 35


def test_shapes_in_sql(spark):
    square = geometry.box_ring(*map(F.lit, (0.0, 0.0, 4.0, 2.0)))
    row = spark.range(1).select(
        geometry.signed_area(square).alias("a"), geometry.centroid(square).alias("c"), geometry.contains(square, F.lit(1.0), F.lit(1.0)).alias("i"),
        geometry.contains(square, F.lit(5.0), F.lit(1.0)).alias("o"), geometry.checked_bbox(*map(F.lit, (-200, -5, 10, 95))).alias("b"),
        geometry.checked_bbox(*map(F.lit, (10, 0, 10, 5))).alias("bad"),
    ).first()
    assert (row.a, row.c.x, row.c.y, row.i, row.o) == (8, 2, 1, True, False)
    assert tuple(row.b) == (-180, -5, 10, 90) and row.bad is None


def test_projections_go_there_and_back(spark):
    rows = spark.createDataFrame([(-106.6, 35.1), (-105.0, 0.0), (-104.2, 36.4)], "lon double, lat double")
    for code in (3857, 26913):
        x, y = crs.reproject(F.col("lon"), F.col("lat"), 4326, code)
        moved = rows.withColumns({"x": x, "y": y})
        lon, lat = crs.reproject(F.col("x"), F.col("y"), code, 4326)
        for r in moved.select("*", lon.alias("lon2"), lat.alias("lat2")).collect():
            assert abs(r.lon - r.lon2) < 1e-8 and abs(r.lat - r.lat2) < 1e-8
    at = rows.filter("lat = 0").select(*[c.alias(n) for c, n in zip(crs.to_utm13(F.col("lon"), F.col("lat")), "xy", strict=True)]).first()
    assert abs(at.x - 500000) < 1e-6 and abs(at.y) < 1e-6
    with pytest.raises(ValueError):
        crs.reproject(F.lit(0.0), F.lit(0.0), 4326, 9999)


def test_labels_burn_by_pixel_centre_and_summaries(spark):
    box = spark.createDataFrame([(1, 1, 3, 5, 7)], "label_id int, x0 int, y0 int, x1 int, y1 int")
    burnt = labels.rasterize(box, 8, 8)
    assert burnt.count() == 16
    grid = windows.window_grid(scenes(spark, (1, 8, 8, 4, 0)))
    counted = labels.positive_pixels(grid, burnt)
    assert {r.tile_idx: r.positive_pixels for r in counted.collect()} == {0: 3, 1: 1, 2: 9, 3: 3}
    summary = labels.chip_summary(counted, 4, 1, False).first()
    assert (summary.windows, summary.chips, summary.positive) == (4, 4, 4)
    ring = box.select(geometry.box_ring(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")).alias("ring"))
    assert labels.rasterize_rings(ring, 8, 8).exceptAll(burnt).count() == 0 and labels.rasterize_rings(ring, 8, 8).count() == 16
    split = labels.chip_split(counted.withColumnRenamed("tile_idx", "chip_idx"), 2, 0.0, 0.5, 7).collect()
    assert {r.split for r in split} <= {"train", "val", "dropped"} and [r.split for r in split if r.positive_pixels == 1] == ["dropped"]
    assert labels.tile_label_join(grid, box, 2).count() == 4


def test_jobs_add_up_and_keep_the_last_known_workflow(spark):
    schema = "job_id string, workflow_id string, feature_count long, loaded_at timestamp, seq long"
    loads = spark.sql("SELECT 'a' job_id, 'w' workflow_id, 2L feature_count, TIMESTAMP '2024-01-01' loaded_at, 1L seq UNION ALL SELECT 'a', NULL, 3L, TIMESTAMP '2024-01-02', 2L UNION ALL SELECT NULL, 'w', 9L, NULL, 3L")
    (job,) = features.upsert_jobs(spark.createDataFrame([], schema), loads).collect()
    assert (job.workflow_id, job.feature_count, job.status, job.loaded_at.day) == ("w", 5, "loaded", 2)
    with pytest.raises(ValueError):
        features.identifier("x\n")


def test_schema_evolution_turns_empty_text_into_null(spark):
    old = spark.createDataFrame([(1, ""), (2, "2024-01-01"), (3, "no")], "id int, loaded_at string")
    out = features.append_evolving(old, spark.sql("SELECT 4 id, 'j' job_id"))
    assert dict(out.dtypes)["loaded_at"] == "timestamp" and [r.loaded_at is None for r in out.orderBy("id").collect()] == [True, False, True, True]


def test_windows_that_meet_polygons(spark):
    grid = windows.window_grid(scenes(spark, (1, 40, 40, 10, 0)))
    t = F.struct(*[F.lit(v).alias(k) for k, v in zip("abcdef", (1.0, 0.0, 0.0, 0.0, -1.0, 40.0), strict=True)])
    ring = lambda *p: [{"x": float(x), "y": float(y)} for x, y in [*p, p[0]]]
    def hit(*rings):
        areas = spark.createDataFrame([([[*rings]],)], "geometry array<array<array<struct<x:double,y:double>>>>")
        return {(r.col_off, r.row_off) for r in windows.touching_polygons(grid, t, areas).collect()}

    assert hit(ring((12, 38), (18, 38), (15, 32))) == {(10, 0)}  # inside one window
    assert hit(ring((1, 39), (2, 39), (19, 22), (18, 22))) >= {(0, 0), (10, 10)}
    assert hit(ring((-5, -5), (45, -5), (45, 45), (-5, 45)), ring((5, 5), (35, 5), (35, 35), (5, 35))) == {
        (x, y) for x in range(0, 40, 10) for y in range(0, 40, 10) if not (10 <= x <= 20 and 10 <= y <= 20)}
    assert hit(ring((100, 100), (101, 100), (101, 101))) == set()


def test_windows_are_never_sent_everywhere(spark, tmp_path):
    scenes(spark, (1, 1000, 1000, 10, 0), (2, 20, 20, 10, 0)).write.parquet(str(tmp_path / "scenes"))  # a small file of many windows
    grid = windows.window_grid(spark.read.parquet(str(tmp_path / "scenes")))
    t = F.struct(*[F.lit(v).alias(k) for k, v in zip("abcdef", (1.0, 0.0, 0.0, 0.0, -1.0, 0.0), strict=True)])
    ring = [{"x": float(x), "y": float(y)} for x, y in ((12, -3), (18, -3), (18, -25), (12, -3))]
    areas = spark.createDataFrame([([[ring]],)] * 2, "geometry array<array<array<struct<x:double,y:double>>>>")
    out = windows.touching_polygons(grid, t, areas, cell=15.0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "BuildLeft" not in plan and plan.count("Join") == 1
    assert sorted((r.scene_id, r.col_off, r.row_off) for r in out.collect()) == [(1, 10, 0), (1, 10, 10), (1, 10, 20), (2, 10, 0), (2, 10, 10)]


def test_chips_pair_and_resize(spark):
    images = spark.createDataFrame([("a", 1), ("b", 2)], "stem string, image int")
    masks = spark.createDataFrame([("a", 3)], "stem string, mask int")
    assert labels.paired_chips(images.filter("stem = 'a'"), masks).first().mask == 3
    with pytest.raises(Exception, match="no mask for b"):
        labels.paired_chips(images, masks).collect()
    image, mask = inference.chip_resized(np.arange(4.0).reshape(1, 2, 2), np.array([[0, 1], [1, 0]]), 4)
    assert image[0, 0].tolist() == [0, 0.25, 0.75, 1] and mask[0].tolist() == [0, 0, 1, 1]


def test_footprints_extents_and_slugs(spark):
    scene = spark.createDataFrame(
        [("s", "/x/s.tif", 26913, 100, 50, 3, "uint8", (10.0, 0.0, 500000.0, 0.0, -10.0, 3900000.0), {"source_item": "i"})],
        "scene_id string, path string, crs_epsg int, width int, height int, band_count int, dtype string, transform struct<a:double,b:double,c:double,d:double,e:double,f:double>, tags map<string,string>")
    row = features.scene_footprints(scene).first()
    assert row.file_name == "s.tif" and row.source_item == "i" and row.source_href == "" and row.native_crs == "EPSG:26913"
    assert abs(row.bounds.west + 105) < 1e-6 and 35 < row.bounds.south < row.bounds.north < 36
    with pytest.raises(Exception, match="no known CRS"):
        features.scene_footprints(scene.withColumn("crs_epsg", F.lit(None).cast("int"))).collect()
    shape = spark.createDataFrame([([[[{"x": -200.0, "y": 1.0}, {"x": 3.0, "y": 5.0}, {"x": 3.0, "y": 1.0}]]],)], "geometry array<array<array<struct<x:double,y:double>>>>")
    assert tuple(features.label_extent(shape).first().bounds) == (-180, 1, 3, 5) and features.label_extent(shape.limit(0)).first().bounds is None
    assert spark.sql("SELECT TIMESTAMP '2024-01-31 23:59:59' t").select(features.time_slug(F.col("t"))).first()[0] == "20240131T235959Z"
    gap = [[1, 1, 1], [1, 0, 1], [1, 1, 1]]
    assert as_grid(morphology.smoothed(pixel_rows(spark, gap), 1)).sum() == 9


def test_overlapping_masks_dissolve_to_one_polygon(spark):
    cells = [(r, c) for r in range(4) for c in range(4)] + [(r, c + 2) for r in range(4) for c in range(4)]
    mask = spark.createDataFrame(cells, "gr long, gc long")
    labelled = morphology.mosaic_components(mask, 3).withColumn("class_name", F.lit(None).cast("string"))
    (one,) = shapes.merged_polygons(labelled).select("class_name", geometry.polygon_area(F.col("rings")).alias("area")).collect()
    assert one.area == 24 and one.class_name is None
    rows = spark.createDataFrame([("t", "road", None, [[[]]]), ("t", "road", 0.5, [[[]], [[]]]), ("t", None, None, [[[]]])], features.FEATURE_SCHEMA)
    (kept,) = features.dissolve_parts(rows).collect()
    assert len(kept.geometry) == 3 and kept.class_name == "road"


def test_shape_functions_take_polygons_with_holes_of_unequal_lengths(spark):
    box = lambda x, y, s: [(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]
    rows = [(0, [box(0.0, 0.0, 9.0)]), (1, [box(0.0, 0.0, 9.0), [(1.0, 1.0), (3.0, 1.0), (3.0, 3.0), (1.0, 1.0)]]), (2, [box(0.0, 0.0, 9.0), box(1.0, 1.0, 1.0), [(5.0, 5.0), (6.0, 5.0), (6.0, 6.0), (5.0, 5.0)]])]
    polygons = spark.createDataFrame(rows, f"k int, rings {shapes.RINGS}")
    for out in (shapes.simplified(polygons, 0.1), shapes.regularized(polygons, 0.1)):
        assert {r.k: len(r.rings) for r in out.collect()} == {0: 1, 1: 2, 2: 3}
    assert {r.k: len(r.rings) for r in shapes.rectangularized(polygons, 0.99).collect()} == {0: 1, 1: 2, 2: 3}
    assert {r.k: len(r.rings) for r in shapes.rectangularized(polygons, 0.9).collect()} == {0: 1, 1: 1, 2: 1}


def test_outlines_keep_area_holes_and_diagonals_apart():
    rng = np.random.default_rng(3)
    for _ in range(50):
        grid = (rng.random((9, 11)) < 0.55).astype(int)
        label = np.where(grid, morphology.label_grid(grid, 4) + 1, 0)
        for k, rings in shapes.trace(label).items():
            assert abs(shapes.area(rings[0])) - sum(abs(shapes.area(r)) for r in rings[1:]) == (label == k).sum()
            assert all(shapes.area(r) * shapes.area(rings[0]) < 0 and r[0] == r[-1] for r in rings[1:])


def test_merged_polygons_are_the_same_for_any_block(spark):
    rng = np.random.default_rng(4)
    grid = (rng.random((23, 31)) < 0.6).astype(int)
    label = morphology.label_grid(grid, 4)
    rows = [("road", int(r), int(c), int(label[r, c])) for r, c in zip(*np.nonzero(grid), strict=True)]
    labelled = spark.createDataFrame(rows, "class_name string, gr long, gc long, label long")
    turned = lambda ring: min(tuple(ring[k:-1] + ring[: k + 1]) for k in range(len(ring) - 1))
    want = {k - 1: sorted(map(turned, rings)) for k, rings in shapes.trace(np.where(grid, label + 1, 0)).items()}
    for block in (512, 7):
        got = {r.label: sorted(turned([(p.x, p.y) for p in ring]) for ring in r.rings) for r in shapes.merged_polygons(labelled, block).collect()}
        assert got == want


def test_repair_of_crossing_touching_and_nested_rings():
    size = lambda parts: sorted(abs(shapes.area(p[0])) - sum(abs(shapes.area(r)) for r in p[1:]) for p in parts)
    box = lambda x, y, s: [(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]
    assert size(shapes.repair([[(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]])) == [1, 1]
    assert size(shapes.repair([[(0, 0), (1, 0), (1, 1), (2, 1), (2, 2), (1, 2), (1, 1), (0, 1)]])) == [1, 1]  # corners that touch, not closed
    assert size(shapes.repair([box(0, 0, 9), box(1, 1, 5), box(2, 2, 1)])) == [1, 56]
    assert size(shapes.repair([box(0, 0, 9)])) == [81] and shapes.repair([[(0, 0), (1, 1), (0, 0)], []]) == []


def test_chip_split_draws_in_order_for_each_scene(spark):
    rng = random.Random(1)
    chips = [(s, k, rng.choice((0, 5, 50))) for s in ("a", "b") for k in range(40)]
    got = {(r.scene, r.chip_idx): r.split for r in labels.chip_split(spark.createDataFrame(chips, "scene string, chip_idx int, positive_pixels int"), 10, 0.4, 0.3, 7, "scene").collect()}
    for scene in ("a", "b"):
        draws = random.Random(7)
        for _, k, positive in [c for c in chips if c[0] == scene]:
            want = "dropped" if positive < 10 and draws.random() > 0.4 else "val" if draws.random() < 0.3 else "train"
            assert got[scene, k] == want


def test_components_of_a_hub_of_stars_and_of_nothing(spark):
    from rasterloom.operators.graph import components

    hub = spark.range(100_000).select(F.lit(10**9).alias("a"), F.col("id").alias("b"))
    assert [(r.root, r.n) for r in components(hub).groupBy("root").agg(F.count(F.lit(1)).alias("n")).collect()] == [(0, 100_001)]
    stars = spark.range(1, 500).select("id", (F.col("id") % 7 - 7).alias("b")).toDF("a", "b")
    assert {r.node: r.root for r in components(stars).collect()} == {k: k % 7 - 7 for k in range(1, 500)} | {k: k for k in range(-7, 0)}
    assert components(hub.limit(0)).count() == 0
