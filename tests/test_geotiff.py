import os
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.operators import windows
from rasterloom.sources import geotiff, tiff

PLACE = (0.5, 0.0, 100.0, 0.0, -0.5, 900.0)


@pytest.fixture(scope="module")
def geo(spark):
    geotiff.register(spark)
    return spark


def picture(bands, height, width, seed=0):
    return np.random.default_rng(seed).integers(0, 1000, (bands, height, width)).astype(np.uint16)


def load(spark, folder, **options):
    return spark.read.format("geotiff").options(**options).load(str(folder))


def test_windows_equal_the_pixels_and_the_grid(geo, tmp_path):
    images = {"strips": picture(3, 150, 90), "tiles": picture(2, 70, 300, 1), "small": picture(1, 20, 30, 2)}
    (tmp_path / "strips.tif").write_bytes(tiff.encode(images["strips"], PLACE, 26913))
    (tmp_path / "tiles.TIFF").write_bytes(geotiff.encode_tiled(images["tiles"], PLACE, 4326, tile=32))
    (tmp_path / "small.tif").write_bytes(tiff.encode(images["small"], PLACE))
    (tmp_path / "notes.txt").write_text("not an image")
    sizes = [(k, v.shape[2], v.shape[1], 64, 8) for k, v in images.items()]
    grid = windows.window_grid(geo.createDataFrame(sizes, "scene_id string, width int, height int, tile_size int, overlap int"))
    want = {(r.scene_id, r.tile_idx): (r.col_off, r.row_off, r.win_width, r.win_height) for r in grid.collect()}
    for part_bytes in (1 << 30, 2000):
        df = load(geo, tmp_path, tileSize=64, overlap=8, partitionBytes=part_bytes)
        rows = df.collect()
        assert {(r.scene_id, r.tile_idx): (r.col_off, r.row_off, r.win_width, r.win_height) for r in rows} == want and len(rows) == len(want)
        for r in rows:
            pixels = images[r.scene_id][:, r.row_off : r.row_off + r.height, r.col_off : r.col_off + r.width]
            assert np.array_equal(np.array(r.bands).reshape(-1, r.height, r.width), pixels)
            assert tuple(r.transform) == (0.5, 0, 100 + 0.5 * r.col_off, 0, -0.5, 900 - 0.5 * r.row_off)
            assert (r.west, r.east, r.north, r.south) == (r.transform.c, r.transform.c + r.width / 2, r.transform.f, r.transform.f - r.height / 2)
        assert {r.scene_id: r.crs_epsg for r in rows} == {"strips": 26913, "tiles": 4326, "small": None}
    assert df.rdd.getNumPartitions() > 3
    one = load(geo, tmp_path / "strips.tif", tileSize=64, bands="3,1").filter("tile_idx = 0").first()
    assert np.array_equal(np.array(one.bands).reshape(2, 64, 64), images["strips"][[2, 0], :64, :64])


def test_filters_settle_what_is_read(geo, tmp_path):
    image = picture(1, 512, 512)
    (tmp_path / "a.tif").write_bytes(geotiff.encode_tiled(image, PLACE, tile=64, overviews=False))
    (tmp_path / "b.tif").write_bytes(b"broken, but no one asks for it")
    df = load(geo, tmp_path, tileSize=64).filter("scene_id = 'a' AND west <= 132 AND east > 131 AND north <= 868 AND tile_idx >= 0")
    assert sorted((r.col_off, r.row_off) for r in df.collect()) == [(0, y) for y in range(64, 512, 64)] + [(64, y) for y in range(64, 512, 64)]
    assert df.filter("scene_id IN ('a', 'c') AND length(path) > 1 AND col_off = 64").count() == 7
    reader = geotiff.GeoTiffReader({"path": str(tmp_path), "tilesize": "64"})
    column = lambda f, name, v: f((name,), v)
    assert list(reader.pushFilters([column(geotiff.EqualTo, "scene_id", "a"), column(geotiff.LessThan, "east", 133.0), column(geotiff.GreaterThan, "north", 890.0)])) == []
    (part,) = reader.partitions()
    opened, read = geotiff.opened, []
    try:
        def noted(path):
            read.append(opened(path))
            return read[-1]

        geotiff.opened = noted
        (batch,) = reader.read(part)
    finally:
        geotiff.opened = opened
    assert batch.num_rows == 1 and read[0].data.read_bytes < 3 * geotiff.PAGE < os.path.getsize(tmp_path / "a.tif") / 2


def test_decimated_reads_take_the_overview_that_is_fine_enough(geo, tmp_path):
    ramp = np.add.outer(np.arange(1024), np.arange(1024) * 2)[None].astype(np.float32)
    data = geotiff.encode_tiled(ramp, PLACE, 26913, {"k": "v<"}, tile=128)
    (tmp_path / "ramp.tif").write_bytes(data)
    image = geotiff.opened(str(tmp_path / "ramp.tif"))
    assert [o.width for o in image.overviews] == [512, 256, 128] and image.items == {"k": "v<"}
    assert all(np.array_equal(o.read()[0], ramp[0, :: 1024 // o.width, :: 1024 // o.width]) for o in image.overviews)
    before = image.data.read_bytes
    small = image.resized(0, 0, 1024, 1024, 128, 128)
    assert image.data.read_bytes - before < len(data) / 20  # pixels read follow the output
    assert np.abs(small[0] - ramp[0, ::8, ::8]).max() <= 3 * 7
    whole = image.resized(0, 0, 512, 512, 512, 512)
    assert np.array_equal(whole[0], ramp[0, :512, :512])
    rows = load(geo, tmp_path, tileSize=512, outputSize=64).collect()
    assert len(rows) == 4 and all((r.height, r.width, r.win_width) == (64, 64, 512) and r.transform.a == 4.0 and r.transform.e == -4.0 for r in rows)
    assert {(r.transform.c, r.transform.f) for r in rows} == {(100.0, 900.0), (356.0, 900.0), (100.0, 644.0), (356.0, 644.0)}


def sparse_file(path, far):
    """A 64-bit TIFF of one band and 256 x 256 tiles whose second tile lies at ``far``; the rest of the file is a hole."""
    tiles = [np.full((256, 256), v, np.uint8).tobytes() for v in (7, 9)]
    fields = [(256, 4, [512]), (257, 4, [256]), (258, 3, [8]), (259, 3, [1]), (262, 3, [1]), (277, 3, [1]), (322, 3, [256]), (323, 3, [256])]
    with open(path, "wb") as f:
        f.write(b"II" + struct.pack("<HHHQ", 43, 8, 0, 16))
        entries = [struct.pack("<HHQ", t, k, 1) + struct.pack("<Q", v[0]) for t, k, v in fields]
        at = 16 + 8 + 20 * (len(fields) + 2) + 8
        entries += [struct.pack("<HHQQ", 324, 16, 2, at), struct.pack("<HHQQ", 325, 16, 2, at + 16)]
        f.write(struct.pack("<Q", len(entries)) + b"".join(entries) + struct.pack("<Q", 0))
        f.write(struct.pack("<QQQQ", 4096, far, 65536, 65536))
        f.seek(4096)
        f.write(tiles[0])
        f.seek(far)
        f.write(tiles[1])


def test_a_file_of_five_gigabytes(geo, tmp_path):
    sparse_file(tmp_path / "large.tif", 5 << 30)
    rows = load(geo, tmp_path, tileSize=256, partitionBytes=1 << 30).select("tile_idx", F.array_distinct(F.element_at("bands", 1)).alias("v")).collect()
    assert {r.tile_idx: r.v for r in rows} == {0: [7.0], 1: [9.0]}
    image = geotiff.opened(str(tmp_path / "large.tif"))
    image.read(256, 0, 256, 256)
    assert image.data.read_bytes < 3 * geotiff.PAGE


def test_errors(geo, tmp_path):
    (tmp_path / "a.tif").write_bytes(tiff.encode(picture(2, 20, 20), PLACE))
    for options in ({"tileSize": 0}, {"tileSize": 8, "overlap": 8}, {"bands": "3"}, {"outputSize": -1}):
        with pytest.raises(Exception, match="bands|must be positive"):
            load(geo, tmp_path, **options).collect()
    (tmp_path / "b.tif").write_bytes(b"PNG" * 50)
    with pytest.raises(Exception, match="not a TIFF"):
        load(geo, tmp_path).collect()


def rows_to_write(spark, n, seed=0):
    rng = np.random.default_rng(seed)
    place = dict(zip("abcdef", PLACE, strict=True))
    rows = [(f"i{k}", 40, 300, [rng.integers(0, 200, 12000).astype(float).tolist()], place, 26913, {"source_item": f"x{k}"}) for k in range(n)]
    return rows, spark.createDataFrame(rows, geotiff.WRITTEN)


def test_written_files_read_back_with_tags_and_overviews(geo, tmp_path):
    rows, df = rows_to_write(geo, 6)
    df.repartition(3).write.format("geotiff").mode("append").option("dtype", "uint8").option("tileSize", 64).save(str(tmp_path / "out"))
    assert sorted(os.listdir(tmp_path / "out")) == [f"i{k}.tif" for k in range(6)]
    for k, row in enumerate(rows):
        image = geotiff.opened(str(tmp_path / "out" / f"i{k}.tif"))
        assert image.read()[0].ravel().tolist() == row[3][0] and image.dtype == np.uint8
        assert image.items == {"source_item": f"x{k}"} and image.epsg == 26913 and image.transform == PLACE and [o.width for o in image.overviews] == [150, 75, 38]
    facts = {r.scene_id: r for r in tiff.scan_scenes(geo, str(tmp_path / "out")).collect()}
    assert facts["i3"].width == 300 and facts["i3"].tags == {"source_item": "x3"}
    rows, df = rows_to_write(geo, 2, 1)
    df.write.format("geotiff").mode("overwrite").save(str(tmp_path / "out"))
    assert sorted(os.listdir(tmp_path / "out")) == ["i0.tif", "i1.tif"]


def test_a_failed_task_leaves_no_file(geo, tmp_path):
    _, df = rows_to_write(geo, 4)
    bad = df.withColumn("name", F.when(F.col("name") == "i2", "no/slash").otherwise(F.col("name"))).repartition(4)
    with pytest.raises(Exception, match="not a file's name"):
        bad.write.format("geotiff").mode("append").save(str(tmp_path / "out"))
    twice = df.withColumn("name", F.lit("same"))
    with pytest.raises(Exception, match="one name"):
        twice.repartition(4).write.format("geotiff").mode("append").save(str(tmp_path / "out"))
    assert [n for _, _, files in os.walk(tmp_path) for n in files] == []


@pytest.mark.parametrize("rows", [84, 99, 128, 163])
def test_an_area_of_interest_of_scenes_of_any_height_is_as_in_sql(geo, tmp_path, rows):
    import duckdb

    from rasterloom.plans.registry import ORACLE_SQL, QUERIES

    con = duckdb.connect()
    con.execute(f"COPY (SELECT * FROM '/root/testdata/sf0.01/embeddings.parquet' WHERE vec_id < {rows}) TO '{tmp_path}/embeddings.parquet' (FORMAT parquet)")
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet'")
    want = con.execute(ORACLE_SQL["geotiff_area_of_interest"]).fetchall()
    assert sorted(map(tuple, QUERIES["geotiff_area_of_interest"](geo, str(tmp_path)).collect())) == sorted(want)


def test_windows_at_the_edge_are_moved_or_cut(geo, tmp_path):
    image = picture(1, 20, 35)
    (tmp_path / "a.tif").write_bytes(tiff.encode(image, PLACE))
    for overlap, xs, ys in ((0, [0, 16, 32], [0, 16]), (4, [0, 12, 24], [0, 12])):
        rows = load(geo, tmp_path, tileSize=16, overlap=overlap, edge="cut").collect()
        assert sorted((r.col_off, r.row_off) for r in rows) == sorted((x, y) for x in xs for y in ys)
        for r in rows:
            part = image[0, r.row_off : r.row_off + 16, r.col_off : r.col_off + 16]
            assert (r.win_height, r.win_width) == part.shape and np.array_equal(np.array(r.bands[0]).reshape(part.shape), part)
    assert geotiff.offsets(20, 16, 0) == [0, 4]
    with pytest.raises(Exception, match="edge must be"):
        load(geo, tmp_path, edge="none").collect()
