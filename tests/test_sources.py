import json
import zipfile

import numpy as np
import pytest

from rasterloom.operators import windows
from rasterloom.plans import catalog
from rasterloom.sources import osm, sinks, tiff, vectors
from rasterloom.streaming import arrivals

SQUARE = [[[{"x": 2.0, "y": 2.0}, {"x": 4.0, "y": 2.0}, {"x": 4.0, "y": 4.0}, {"x": 2.0, "y": 4.0}, {"x": 2.0, "y": 2.0}]]]


def test_tiff_round_trip_by_windows(spark, tmp_path):
    image = (np.arange(3 * 150 * 90) % 251).astype(np.uint8).reshape(3, 150, 90)
    (tmp_path / "scene.tif").write_bytes(tiff.encode(image, (0.5, 0, 100.0, 0, -0.5, 900.0), 26913, {"source_item": "a<b"}))
    (tmp_path / "other.tiff").write_bytes(tiff.encode(image[:1].astype(np.float32) / 7, (1, 0, 0, 0, -1, 0), 4326))
    facts = {r.scene_id: r for r in tiff.scan_scenes(spark, str(tmp_path)).collect()}
    one = facts["scene"]
    assert (one.crs_epsg, one.width, one.height, one.band_count, one.dtype, one.tags) == (26913, 90, 150, 3, "uint8", {"source_item": "a<b"})
    assert tuple(one.transform) == (0.5, 0, 100.0, 0, -0.5, 900.0) and facts["other"].dtype == "float32"
    grid = windows.window_grid(spark.createDataFrame([("scene", 90, 150, 64, 8)], "scene_id string, width int, height int, tile_size int, overlap int"))
    tiles = tiff.read_windows(spark, str(tmp_path), grid, bands=[3, 1])
    at = {f"scene_tile_{r.tile_idx:06d}": r for r in grid.collect()}
    for t in tiles.collect():
        w = at[t.tile_id]
        want = image[[2, 0], w.row_off : w.row_off + 64, w.col_off : w.col_off + 64]
        assert np.array_equal(np.array(t.bands).reshape(2, 64, 64), want)


def test_tiff_rejects_other_bytes():
    with pytest.raises(ValueError):
        tiff.Tiff(b"PNG.....")


def test_mask_files(spark):
    rows = [("t", 2, 2, [[0.0, 1.0, 1.0, 0.0]], {"a": 1.0, "b": 0.0, "c": 10.0, "d": 0.0, "e": -1.0, "f": 20.0}, 26913, {"class_name": "road"})]
    tiles = spark.createDataFrame(rows, "tile_id string, height int, width int, bands array<array<float>>, transform struct<a:double,b:double,c:double,d:double,e:double,f:double>, crs_epsg int, tags map<string,string>")
    (file,) = sinks.tiff_files(tiles).collect()
    back = tiff.Tiff(bytes(file.content))
    assert back.read()[0].tolist() == [[0, 1], [1, 0]] and back.items == {"class_name": "road"} and back.epsg == 26913


def test_vector_files(spark, tmp_path):
    collection = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"n": 1}, "geometry": {"type": "Polygon", "coordinates": [[[2, 2], [4, 2], [4, 4], [2, 4], [2, 2]]]}},
        {"type": "Feature", "properties": {}, "geometry": None},
    ]}
    (tmp_path / "a.geojson").write_text(json.dumps(collection))
    (one,) = vectors.read_geojson(spark, str(tmp_path / "a.geojson")).collect()
    assert json.loads(one.properties) == {"n": 1} and len(one.geometry[0][0]) == 5
    (tmp_path / "b.gpkg").write_bytes(vectors.gpkg_bytes([({"name": "x"}, SQUARE)], 26913, "buildings"))
    (row,) = vectors.read_vectors(spark, str(tmp_path / "b.gpkg")).collect()
    assert row.crs_epsg == 26913 and json.loads(row.properties)["name"] == "x" and row.geometry[0][0][1].x == 4
    with zipfile.ZipFile(tmp_path / "c.zip", "w") as z:
        z.writestr("readme.txt", "no")
        z.writestr("first.geojson", json.dumps(collection))
        z.write(tmp_path / "b.gpkg", "second.gpkg")
    (first,) = vectors.read_vectors(spark, str(tmp_path / "c.zip")).collect()
    assert first.crs_epsg == 4326


def test_feature_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("s", "road", None, SQUARE), ("t", None, 0.5, SQUARE)], "source_tile string, class_name string, confidence double, geometry array<array<array<struct<x:double,y:double>>>>")
    sinks.write_geojson_lines(rows, str(tmp_path / "lines"))
    back = vectors.geojson_features(spark.read.text(str(tmp_path / "lines")))
    assert back.count() == 2 and json.loads(back.filter("properties like '%road%'").first().properties) == {"source_tile": "s", "class_name": "road", "confidence": None}
    packages = sinks.geopackages(rows, "source_tile").collect()
    assert sorted(p.source_tile for p in packages) == ["s", "t"] and bytes(packages[0].content)[:6] == b"SQLite"
    assert sinks.empty_features(spark).columns == rows.columns


def ring(x, y, side):
    return [{"x": float(x + dx * side), "y": float(y + dy * side)} for dx, dy in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))]


def test_geopackages_of_polygons_with_holes(spark, tmp_path):
    triangle = [{"x": 6.0, "y": 6.0}, {"x": 8.0, "y": 6.0}, {"x": 8.0, "y": 8.0}, {"x": 6.0, "y": 6.0}]
    shapes = {"none": [ring(0, 0, 9)], "one": [ring(0, 0, 9), triangle], "two": [ring(0, 0, 9), ring(1, 1, 2), triangle]}
    rows = spark.createDataFrame([(k, "hot", [v]) for k, v in shapes.items()] + [("null", "hot", None)], "name string, scene string, geometry array<array<array<struct<x:double,y:double>>>>")
    for most, packages in ((100, 1), (2, 2)):
        out = sinks.geopackages(rows, "scene", most=most).collect()
        assert len({p.part for p in out}) == len(out) <= packages
        back = {}
        for p in out:
            (tmp_path / f"{most}-{p.part}.gpkg").write_bytes(bytes(p.content))
            for r in vectors.read_vectors(spark, str(tmp_path / f"{most}-{p.part}.gpkg")).collect():
                back[json.loads(r.properties)["name"]] = [[q.asDict() for q in line] for line in r.geometry[0]]
        assert back == shapes  # a feature without a shape has no row among the polygons


def test_loading_and_the_job_log(spark, tmp_path):
    rows = spark.createDataFrame([("s", SQUARE)], "source_tile string, geometry array<array<array<struct<x:double,y:double>>>>")
    folder = str(tmp_path)
    assert sinks.load_features(rows, folder, "append", "job", {"workflow_id": "w"}, seq=1) == 1
    assert sinks.load_features(rows, folder, "append", "job", seq=2) == 1
    assert sinks.load_features(rows.limit(0), folder, "replace", "job", seq=3) == 0
    assert sinks.stored_features(spark, folder).count() == 2 and "workflow_id" in sinks.stored_features(spark, folder).columns
    (job,) = sinks.jobs(spark, folder).collect()
    assert (job.feature_count, job.workflow_id, job.status) == (2, "w", "loaded")
    with pytest.raises(ValueError):
        sinks.load_features(rows, folder, "merge")
    with pytest.raises(ValueError):
        sinks.load_features(rows, folder, metadata={"bad name": "x"})


def test_streamed_loads_count_once(spark, tmp_path):
    made = spark.sql("SELECT 'j' job_id, 'w' workflow_id, 't1' tile_id, 4L features, TIMESTAMP '2024-01-01' loaded_at UNION ALL SELECT 'j', NULL, 't2', 5L, TIMESTAMP '2024-01-02' UNION ALL SELECT NULL, NULL, 't3', 1L, NULL")
    made.write.parquet(str(tmp_path / "in"))
    stream = arrivals.arrivals(spark, str(tmp_path / "in"))
    arrivals.load_jobs(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    arrivals.load_jobs(stream, str(tmp_path / "out"), str(tmp_path / "cp2")).awaitTermination(60)  # the same batch again
    (job,) = sinks.jobs(spark, str(tmp_path / "out")).collect()
    assert (job.feature_count, job.workflow_id) == (9, "w")
    assert arrivals.counts_by_hour(stream).isStreaming


def test_osm_elements(spark):
    line = [{"lat": 0.0, "lon": 0.0}, {"lat": 0.0, "lon": 2.0}, {"lat": 2.0, "lon": 2.0}, {"lat": 2.0, "lon": 0.0}]
    elements = [
        {"type": "way", "id": 123, "tags": {"building": "yes", "name": "A"}, "geometry": line},
        {"type": "way", "id": 5, "geometry": line[:3]}, {"type": "node", "id": 6},
        {"type": "relation", "id": 7, "members": [{"role": "outer", "geometry": line}, {"role": "inner", "geometry": line}, {"role": "", "geometry": line}]},
    ]
    rows = {r.osm_id: r for r in osm.buildings(osm.fetched(spark, lambda: [json.dumps(e) for e in elements]), "label-package").collect()}
    assert set(rows) == {123, 7} and rows[123].name == "A" and rows[123].extent_source == "labels"
    assert len(rows[123].geometry[0][0]) == 5 and len(rows[7].geometry) == 2
    with pytest.raises(Exception, match="imagery or labels"):
        osm.buildings(osm.fetched(spark, lambda: [json.dumps(elements[0])]), "moon").collect()


def test_catalog(spark, tmp_path):
    workflows = spark.createDataFrame([("a", "m", "roads", True), ("b", "x", "roads", False), ("b", None, "rails", True)], "id string, model string, type string, enabled boolean")
    models = spark.createDataFrame([("m",)], "id string")
    assert {(r.problem, r.id) for r in catalog.problems(workflows, models).collect()} == {("repeated workflow", "b"), ("unknown model", "b"), ("unknown type", "b")}
    single = workflows.limit(2)
    assert [r.id for r in catalog.select(single, ["b", "a"]).collect()] == ["b", "a"]
    with pytest.raises(ValueError):
        catalog.select(single, ["z"])
    with pytest.raises(ValueError):
        catalog.select(single, ["b"], "m")
    out, told = catalog.run_stages([("one", lambda d: d.filter("enabled")), ("two", lambda d: d.select("nothing"))], workflows, str(tmp_path))
    assert out is None and told[0].rows == 2 and told[1].error
