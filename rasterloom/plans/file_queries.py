"""Registered queries of sources, sinks and the catalog: what is written is read again and compared with its source."""

from __future__ import annotations

from pyspark.sql import functions as F

from rasterloom.functions import geometry
from rasterloom.operators import features, inference, windows
from rasterloom.operators.graph import fresh_folder
from rasterloom.plans import catalog
from rasterloom.plans.fixtures import table
from rasterloom.plans.queries import query
from rasterloom.sources import geotiff, sinks, tiff, vectors


def _tagged_tiles(spark, d):
    tiles = inference.blocked_form(table(spark, d, "raster").withColumn("band", F.lit(0)).withColumn("v", F.col("v").cast("double")))
    place = F.struct(*[F.lit(v).alias(k) for k, v in zip("abcdef", (0.5, 0.0, 100.0, 0.0, -0.5, 900.0), strict=True)])
    return tiles.withColumns({"transform": place, "crs_epsg": F.lit(26913), "tags": F.create_map(F.lit("class_name"), F.lit("road"))})


def _tile_files(spark, d):
    """A GeoTIFF, with a place, a CRS and a tag, of every tile of the raster, as files(path, content)."""
    tagged = _tagged_tiles(spark, d)
    return sinks.tiff_files(tagged, "float32").withColumnRenamed("name", "path")


@query("tiff_scene_facts", "SELECT CAST(tile_id AS VARCHAR) AS scene_id, 26913 AS crs_epsg, max(c) + 1 AS width, max(r) + 1 AS height, 1 AS band_count, 'float32' AS dtype, 'road' AS class_name FROM raster GROUP BY tile_id")
def tiff_scene_facts(spark, d):
    """The raster's tiles written as GeoTIFFs: size, CRS, type and tags read from the files."""
    facts = tiff.scene_facts(_tile_files(spark, d))
    return facts.select("scene_id", "crs_epsg", "width", "height", "band_count", "dtype", F.col("tags")["class_name"].alias("class_name"))


_WINDOWS = """s AS (SELECT tile_id, max(r) + 1 AS h, max(c) + 1 AS w FROM raster GROUP BY tile_id),
ws AS (SELECT tile_id, unnest(list_distinct(list_append(range(0, greatest(w - 32, 0) + 1, 24), greatest(w - 32, 0)))) AS x, h, w FROM s),
wn AS (SELECT tile_id, x, unnest(list_distinct(list_append(range(0, greatest(h - 32, 0) + 1, 24), greatest(h - 32, 0)))) AS y, h, w FROM ws)"""


@query("tiff_windows", f"WITH {_WINDOWS} SELECT CAST(wn.tile_id AS VARCHAR) AS scene_id, CAST(least(32, w - x) AS INT) AS width, CAST(least(32, h - y) AS INT) AS height, CAST(sum(v) AS DOUBLE) AS total FROM wn JOIN raster q ON q.tile_id = wn.tile_id AND q.c >= x AND q.c < x + 32 AND q.r >= y AND q.r < y + 32 GROUP BY wn.tile_id, x, y, w, h")
def tiff_windows(spark, d):
    """Overlapping windows cut from the raster's GeoTIFFs."""
    sizes = table(spark, d, "raster").groupBy("tile_id").agg((F.max("c") + 1).alias("width"), (F.max("r") + 1).alias("height"))
    scenes = sizes.select(F.col("tile_id").cast("string").alias("scene_id"), "width", "height", F.lit(32).alias("tile_size"), F.lit(8).alias("overlap"))
    tiles = tiff.cut_windows(_tile_files(spark, d), windows.window_grid(scenes), bands=[1])
    total = F.aggregate(F.element_at("bands", 1), F.lit(0.0), lambda s, v: s + v.cast("double"))
    return tiles.select("scene_id", "width", "height", total.alias("total"))


def _tile_folder(spark, d) -> str:
    """The raster's tiles as GeoTIFF files, in tiles of 16 pixels with overviews, written by the data source."""
    geotiff.register(spark)
    folder = fresh_folder(spark, "geotiffs")
    named = _tagged_tiles(spark, d).select(
        F.col("tile_id").cast("string").alias("name"), "height", "width", F.col("bands").cast("array<array<double>>").alias("bands"), "transform", "crs_epsg", "tags"
    )
    named.write.format("geotiff").mode("append").option("tileSize", 16).save(folder)
    return folder


@query("geotiff_windows", f"WITH {_WINDOWS} SELECT CAST(wn.tile_id AS VARCHAR) AS scene_id, CAST(x AS INT) AS col_off, CAST(y AS INT) AS row_off, CAST(least(32, w - x) AS INT) AS width, CAST(least(32, h - y) AS INT) AS height, CAST(100 + x / 2 AS DOUBLE) AS west, CAST(900 - y / 2 AS DOUBLE) AS north, CAST(sum(v) AS DOUBLE) AS total FROM wn JOIN raster q ON q.tile_id = wn.tile_id AND q.c >= x AND q.c < x + 32 AND q.r >= y AND q.r < y + 32 GROUP BY wn.tile_id, x, y, w, h")
def geotiff_windows(spark, d):
    """Overlapping windows read by byte ranges from the raster's GeoTIFF files, a few windows a partition."""
    tiles = spark.read.format("geotiff").option("tileSize", 32).option("overlap", 8).option("partitionBytes", 8192).load(_tile_folder(spark, d))
    total = F.aggregate(F.element_at("bands", 1), F.lit(0.0), lambda s, v: s + v.cast("double"))
    return tiles.select("scene_id", "col_off", "row_off", "width", "height", F.col("transform.c").alias("west"), F.col("transform.f").alias("north"), total.alias("total"))


@query("geotiff_area_of_interest", "SELECT CAST(tile_id AS VARCHAR) AS scene_id, CAST(c // 16 * 16 AS INT) AS col_off, CAST(r // 16 * 16 AS INT) AS row_off, CAST(max(v) AS DOUBLE) AS most FROM raster q WHERE c // 16 * 8 + 100 < 118 AND (c // 16 + 1) * 8 + 100 > 109 AND 900 - r // 16 * 8 > 890 AND EXISTS (SELECT 1 FROM raster w WHERE w.tile_id = q.tile_id AND w.r >= 16) GROUP BY tile_id, c // 16, r // 16")
def geotiff_area_of_interest(spark, d):
    """Only the windows that meet an area, of scenes of more than one row of windows: filters reach the files' blocks.

    A scene's windows are a grid of 16 pixels, whatever its height; those at its edge are smaller."""
    tiles = spark.read.format("geotiff").option("tileSize", 16).option("edge", "cut").load(_tile_folder(spark, d))
    most = F.array_max(F.element_at("bands", 1)).cast("double")
    near = tiles.filter("west < 118 AND east > 109 AND north > 890").select("scene_id", "col_off", "row_off", most.alias("most"))
    tall = table(spark, d, "raster").filter("r >= 16").select(F.col("tile_id").cast("string").alias("scene_id")).distinct()
    return near.join(tall, "scene_id", "left_semi")


@query("geotiff_decimated", "SELECT CAST(tile_id AS VARCHAR) AS scene_id, 16 AS width, CAST(2.0 AS DOUBLE) AS pixel, CAST(sum(v) FILTER (WHERE r % 4 = 0 AND c % 4 = 0) AS DOUBLE) AS total FROM raster GROUP BY tile_id HAVING max(r) = 63")
def geotiff_decimated(spark, d):
    """Whole scenes at a quarter of their size, read from the overview of that size; the transform's pixels are larger."""
    small = spark.read.format("geotiff").option("tileSize", 64).option("outputSize", 16).load(_tile_folder(spark, d)).filter("win_height = 64")
    total = F.aggregate(F.element_at("bands", 1), F.lit(0.0), lambda s, v: s + v.cast("double"))
    return small.select("scene_id", "width", F.col("transform.a").alias("pixel"), total.alias("total"))


@query("tile_store", "SELECT tile_id, CAST(sum(v) AS BIGINT) AS total, count(*) AS pixels FROM raster GROUP BY tile_id")
def tile_store(spark, d):
    """Tiles written by scene and written again: the second run replaces its scenes and leaves the rest."""
    raster, folder = table(spark, d, "raster"), fresh_folder(spark, "tiles")
    sinks.write_tiles(raster.withColumn("v", F.when(F.col("tile_id") % 2 == 0, F.col("v")).otherwise(0)), folder, "tile_id")
    sinks.write_tiles(raster.filter("tile_id % 2 = 1"), folder, "tile_id")
    return spark.read.parquet(folder).groupBy("tile_id").agg(F.sum("v").alias("total"), F.count(F.lit(1)).alias("pixels"))


def _features(spark, d):
    ring = geometry.box_ring(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))
    hole = geometry.box_ring(F.col("x0") + 2, F.col("y0") + 2, F.col("x1") - 2, F.col("y1") - 2)
    rings = F.when(F.expr("x1 - x0 >= 12 AND y1 - y0 >= 12"), F.array(ring, hole)).otherwise(F.array(ring))
    return table(spark, d, "boxes").select("label_id", (F.col("label_id") % 9).alias("scene"), F.array(rings).alias("geometry"))


_AREA = "CAST((x1 - x0) * (y1 - y0) - CASE WHEN x1 - x0 >= 12 AND y1 - y0 >= 12 THEN (x1 - x0 - 4) * (y1 - y0 - 4) ELSE 0 END AS DOUBLE)"


def _read_back(found):
    area = F.aggregate("geometry", F.lit(0.0), lambda s, p: s + geometry.polygon_area(p))
    return found.select(F.get_json_object("properties", "$.label_id").cast("long").alias("label_id"), area.alias("area"))


@query("geojson_round_trip", f"SELECT label_id, {_AREA} AS area FROM boxes")
def geojson_round_trip(spark, d):
    """Polygons with holes written as GeoJSON lines and parsed again."""
    folder = fresh_folder(spark, "geojson")
    sinks.write_geojson_lines(_features(spark, d), folder)
    return _read_back(vectors.geojson_features(spark.read.text(folder)))


@query("geojson_collections", f"SELECT label_id, {_AREA} AS area FROM boxes")
def geojson_collections(spark, d):
    """The same as feature collections, one a scene."""
    lines = _features(spark, d).select("scene", sinks.feature_json(["label_id"]).alias("f"))
    texts = lines.groupBy("scene").agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.collect_list("f"), ","), F.lit("]}")).alias("value"))
    return _read_back(vectors.geojson_features(texts))


@query("geopackage_round_trip", f"SELECT label_id, {_AREA} AS area FROM boxes")
def geopackage_round_trip(spark, d):
    """Polygons with holes as GeoPackages of at most about 40 features, read again."""
    packages = sinks.geopackages(_features(spark, d), "scene", 26913, "roads", most=40)
    files = packages.select(F.concat("scene", F.lit("-"), "part", F.lit(".gpkg")).alias("path"), "content")
    return _read_back(vectors.vector_features(files, "roads"))


@query("label_fallback", "SELECT label_id FROM boxes")
def label_fallback(spark, d):
    """No stored labels, an empty file, then seed detections: the seeds are the labels."""
    seeds = _features(spark, d)
    return vectors.label_source([None, seeds.limit(0), seeds]).select("label_id")


@query("feature_loads", "SELECT 'job' || label_id % 4 AS job_id, CAST(count(*) AS BIGINT) AS feature_count, 'loaded' AS status FROM boxes GROUP BY 1")
def feature_loads(spark, d):
    """Features appended job by job, an empty load among them; the log's roll-up counts them."""
    folder, rows = fresh_folder(spark, "loads"), _features(spark, d)
    for k in range(4):
        sinks.load_features(rows.filter(F.col("label_id") % 4 == k), folder, "append", f"job{k}", seq=k)
    sinks.load_features(rows.limit(0), folder, "replace", "job0", seq=9)
    return sinks.jobs(spark, folder).select("job_id", "feature_count", "status")


@query("chip_manifest", "SELECT CASE WHEN label_id % 5 = 0 THEN 'val' ELSE 'train' END AS split, 'i' || label_id || '.tif' AS image, CAST((x1 - x0) * (y1 - y0) AS INT) AS positive_pixels, printf('%.8f,%.8f,%.8f,%.8f', CAST(x0 AS DOUBLE), CAST(y0 AS DOUBLE), CAST(x1 AS DOUBLE), CAST(y1 AS DOUBLE)) AS bounds FROM boxes")
def chip_manifest(spark, d):
    """The CSV manifest, written and read again."""
    x0, y0, x1, y1 = (F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1"))
    chips = table(spark, d, "boxes").select(
        F.when(F.col("label_id") % 5 == 0, "val").otherwise("train").alias("split"), F.concat(F.lit("i"), "label_id", F.lit(".tif")).alias("image"),
        F.concat(F.lit("m"), "label_id", F.lit(".tif")).alias("mask"), ((x1 - x0) * (y1 - y0)).cast("int").alias("positive_pixels"),
        x0.alias("west"), y0.alias("south"), x1.alias("east"), y1.alias("north"),
    )
    folder = fresh_folder(spark, "manifest")
    sinks.write_manifest(chips, folder)
    schema = "split string, image string, mask string, positive_pixels int, bounds string"
    return spark.read.schema(schema).option("header", True).csv(folder).select("split", "image", "positive_pixels", "bounds")


@query("scene_footprints", "SELECT CAST(scene_id AS VARCHAR) AS cog_id, width, height, 'a' AS source_item, '' AS source_href, CAST(-105.0 AS DOUBLE) AS west, round(CAST(36.0 - height * 0.001 AS DOUBLE), 6) AS south, round(CAST(-105.0 + width * 0.001 AS DOUBLE), 6) AS east, CAST(36.0 AS DOUBLE) AS north FROM scenes")
def scene_footprints(spark, d):
    place = F.struct(*[F.lit(v).alias(k) for k, v in zip("abcdef", (0.001, 0.0, -105.0, 0.0, -0.001, 36.0), strict=True)])
    scenes = table(spark, d, "scenes").select(
        F.col("scene_id").cast("string").alias("scene_id"), F.concat(F.lit("/x/"), "scene_id", F.lit(".tif")).alias("path"), F.lit(4326).alias("crs_epsg"),
        "width", "height", F.lit(3).alias("band_count"), place.alias("transform"), F.create_map(F.lit("source_item"), F.lit("a")).alias("tags"),
    )
    b = [F.round(f"bounds.{k}", 6).alias(k) for k in ("west", "south", "east", "north")]
    return features.scene_footprints(scenes).select("cog_id", "width", "height", "source_item", "source_href", *b)


@query("catalog_problems", "SELECT 'unknown model' AS problem, n_name AS id FROM nation WHERE n_regionkey = 4 UNION ALL SELECT 'unknown type', n_name FROM nation WHERE n_nationkey % 6 = 0 UNION ALL SELECT 'too many workflows', CAST(count(*) AS VARCHAR) FROM nation HAVING count(*) > 10")
def catalog_problems(spark, d):
    """A catalog with a workflow for each nation and a model for each region but one."""
    nations = spark.read.parquet(f"{d}/nation.parquet")
    workflows = nations.select(
        F.col("n_name").alias("id"), F.concat(F.lit("m"), "n_regionkey").alias("model"),
        F.when(F.col("n_nationkey") % 6 == 0, "rails").otherwise("roads").alias("type"), F.lit(True).alias("enabled"),
    )
    models = spark.read.parquet(f"{d}/region.parquet").filter("r_regionkey <> 4").select(F.concat(F.lit("m"), "r_regionkey").alias("id"))
    return catalog.problems(workflows, models)


@query("catalog_selection", "SELECT n_name AS id, n_regionkey AS region FROM nation WHERE n_nationkey IN (2, 7, 11)")
def catalog_selection(spark, d):
    """Three workflows asked for by name, enabled or not."""
    nations = spark.read.parquet(f"{d}/nation.parquet")
    workflows = nations.select(F.col("n_name").alias("id"), F.lit(None).cast("string").alias("model"), F.lit("roads").alias("type"), F.lit(False).alias("enabled"), F.col("n_regionkey").alias("region"))
    return catalog.select(workflows, ["NATION_2", "NATION_7", "NATION_11"]).select("id", "region")


@query("stac_by_id", "SELECT item_id FROM items WHERE item_id = (SELECT min(item_id) FROM items)")
def stac_by_id(spark, d):
    """An item asked for by its id."""
    items = table(spark, d, "items")
    wanted = items.agg(F.min("item_id").alias("wanted"))
    return features.best_item(items.join(wanted, F.col("item_id") == F.col("wanted")), 0.0, 0.0, 1.0, 1.0).select("item_id")
