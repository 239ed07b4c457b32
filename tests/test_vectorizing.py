import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.functions.geometry import polygon_area
from rasterloom.plans import catalog, vectorizing

RINGS = "array<array<struct<x:double,y:double>>>"


def box(x, y, w, h):
    return [{"x": float(a), "y": float(b)} for a, b in ((x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y))]


def rows_of(spark, rows):
    return spark.createDataFrame(rows, f"source_tile string, class_name string, rings {RINGS}")


def run(spark, rows, **options):
    out = vectorizing.vectorized(rows_of(spark, rows), vectorizing.Options(cell=64.0, **options))
    area = F.aggregate("geometry", F.lit(0.0), lambda s, p: s + polygon_area(p))
    return sorted((r.source_tile, r.class_name, len(r.geometry), round(r.area, 3)) for r in out.withColumn("area", area).collect())


OVERLAPPING = [("a", "road", [box(0, 0, 10, 4)]), ("b", "road", [box(8, 0, 10, 4)]), ("b", "road", [box(40, 0, 1, 1)]), ("b", "roof", [box(8, 0, 2, 2)])]


def test_by_tile_or_over_all_tiles(spark):
    assert run(spark, OVERLAPPING, min_area=2.0) == [("a", "road", 1, 40.0), ("b", "road", 1, 40.0), ("b", "roof", 1, 4.0)]
    assert run(spark, OVERLAPPING) == [("a", "road", 1, 40.0), ("b", "road", 2, 41.0), ("b", "roof", 1, 4.0)]
    merged = run(spark, OVERLAPPING, dissolve_overlaps=True)
    assert merged == [("merged", "road", 1, 1.0), ("merged", "road", 1, 72.0), ("merged", "roof", 1, 4.0)]
    crossing = [("a", "road", [[{"x": 0.0, "y": 0.0}, {"x": 4.0, "y": 4.0}, {"x": 4.0, "y": 0.0}, {"x": 0.0, "y": 4.0}, {"x": 0.0, "y": 0.0}]])]
    assert run(spark, crossing) == [("a", "road", 2, 8.0)] and run(spark, crossing, min_area=9.0) == []


def test_smoothing_closes_gaps_and_rectangles_stay_features(spark):
    apart = [("a", "road", [box(0, 0, 10, 4)]), ("b", "road", [box(11, 0, 9, 4)])]
    (one,) = run(spark, apart, dissolve_overlaps=True, smooth=0.0)[:1]
    assert one[3] == 36.0
    assert [r[2] for r in run(spark, [("a", "road", [box(0, 0, 10, 4)]), ("a", "road", [box(11, 0, 9, 4)])], smooth=0.75)] == [1]
    notched = [("a", "road", [[{"x": float(x), "y": float(y)} for x, y in ((0, 0), (10, 0), (10, 6), (5.2, 6), (5, 5.8), (4.8, 6), (0, 6), (0, 0))]])] * 2
    assert run(spark, notched, rectangularize=0.9) == [("a", "road", 1, 60.0)] * 2


def test_regularised_features_are_straight(spark):
    wavy = [(0, 0), (5, 0.3), (10, 0), (10.2, 3), (10, 6), (5, 5.8), (0, 6), (-0.2, 3), (0, 0)]
    ring = [{"x": float(x), "y": float(y)} for x, y in wavy]
    out = vectorizing.vectorized(rows_of(spark, [("a", "roof", [ring])]), vectorizing.Options(regularize=True, regularize_simplify=0.5)).collect()
    (part,) = out[0].geometry
    corners = np.array(part[0])
    assert len(corners) == 5 and all(abs(a @ b) < 1e-2 for a, b in zip(np.diff(corners, axis=0)[:-1], np.diff(corners, axis=0)[1:], strict=True))


def test_projection_and_empty_tables(spark):
    rows = rows_of(spark, [("a", "road", [box(-105.0, 35.0, 0.01, 0.01)])])
    out = vectorizing.vectorized(rows, vectorizing.Options(min_area=1000.0), 4326, 26913, 4326).collect()
    xs = [p.x for p in out[0].geometry[0][0]]
    assert min(xs) == pytest.approx(-105.0, abs=1e-6) and max(xs) == pytest.approx(-104.99, abs=1e-6)
    assert vectorizing.vectorized(rows.limit(0), vectorizing.Options(dissolve_overlaps=True, smooth=1.0, regularize=True)).collect() == []


def test_masks_that_are_too_full_are_left_out(spark):
    dense = [(t, r, c, int(t == 0 or r == c)) for t in (0, 1) for r in range(4) for c in range(4)]
    masks = spark.createDataFrame(dense, "tile_id int, r int, c int, mask int")
    assert {r.source_tile for r in vectorizing.mask_polygons(masks, vectorizing.Options(most_coverage=0.5)).collect()} == {1}
    assert {r.source_tile for r in vectorizing.mask_polygons(masks, vectorizing.Options()).collect()} == {0, 1}


def test_other_workflows_go_on_and_finished_stages_stay(spark, tmp_path):
    def fails(df):
        raise RuntimeError("no model")

    start = spark.range(5).toDF("n")
    double = ("double", lambda df: df.selectExpr("n * 2 AS n"))
    out = catalog.run_workflows({"bad": [double, ("infer", fails), double], "good": [double]}, start, str(tmp_path))
    df, told = out["bad"]
    assert df is None and [(t.stage, t.rows, t.error) for t in told] == [("double", 5, None), ("infer", None, "no model")]
    assert spark.read.parquet(f"{tmp_path}/bad/double").count() == 5
    assert out["good"][0].agg({"n": "max"}).first()[0] == 8
