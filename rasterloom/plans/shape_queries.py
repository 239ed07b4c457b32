"""Registered queries of polygon, label and projection operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from rasterloom.functions import geometry
from rasterloom.operators import features, inference, labels, morphology, overlay, shapes, windows
from rasterloom.plans.fixtures import table
from rasterloom.plans import vectorizing
from rasterloom.plans.queries import GRID, SCENE, _components, _mask, _values, query

HOLED = "x1 - x0 >= 12 AND y1 - y0 >= 12"  # boxes with room for a hole two pixels from their sides


def _boxes(spark, d, where: str = "true"):
    return table(spark, d, "boxes").filter(where)


def _box(edge: int = 0):
    return geometry.box_ring(F.col("x0") + edge, F.col("y0") + edge, F.col("x1") - edge, F.col("y1") - edge)


def _total(rings):
    return F.aggregate(rings, F.lit(0.0), lambda s, p: s + geometry.polygon_area(p))


def _inside(edge: int) -> str:
    return f"x + 0.5 > x0 + {edge} AND x + 0.5 < x1 - {edge} AND y + 0.5 > y0 + {edge} AND y + 0.5 < y1 - {edge}"


PIXELS = f"range({SCENE}) a(x), range({SCENE}) b(y)"


@query("rasterize_polygons", f"SELECT CAST(y AS INT) AS r, count(DISTINCT x) AS pixels, CAST(sum(DISTINCT x) AS BIGINT) AS places FROM boxes, {PIXELS} WHERE {_inside(0)} AND NOT (x1 - x0 >= 12 AND y1 - y0 >= 12 AND {_inside(2)}) GROUP BY y")
def rasterize_polygons(spark, d):
    """Boxes, the larger ones with a hole, by their pixels' centres."""
    rings = F.when(F.expr(HOLED), F.array(_box(), _box(2))).otherwise(F.array(_box()))
    burnt = labels.rasterize_rings(_boxes(spark, d).select(rings.alias("rings")), SCENE, SCENE)
    return burnt.groupBy("r").agg(F.count(F.lit(1)).alias("pixels"), F.sum("c").alias("places"))


@query("rasterize_all_touched", f"SELECT CAST(y AS INT) AS r, count(DISTINCT x) AS pixels FROM boxes, {PIXELS} WHERE x + 1 >= x0 + 0.5 AND x <= x1 - 0.5 AND y + 1 >= y0 + 0.5 AND y <= y1 - 0.5 GROUP BY y")
def rasterize_all_touched(spark, d):
    shrunk = geometry.box_ring(F.col("x0") + 0.5, F.col("y0") + 0.5, F.col("x1") - 0.5, F.col("y1") - 0.5)
    burnt = labels.rasterize_rings(_boxes(spark, d).select(shrunk.alias("ring")), SCENE, SCENE, all_touched=True)
    return burnt.groupBy("r").agg(F.count(F.lit(1)).alias("pixels"))


@query("repaired_polygons", "SELECT label_id, 2 AS parts, CAST((x1 - x0) * (y1 - y0) / 2.0 AS DOUBLE) AS area FROM boxes")
def repaired_polygons(spark, d):
    """Boxes whose corners come in an order that makes the ring cross itself."""
    x0, y0, x1, y1 = (F.col(c) for c in ("x0", "y0", "x1", "y1"))
    bow = F.array(*[geometry.point(x, y) for x, y in ((x0, y0), (x1, y1), (x1, y0), (x0, y1), (x0, y0))])
    out = overlay.repaired(overlay.spread(_boxes(spark, d)).withColumn("rings", F.array(bow)))
    return out.select("label_id", F.size("geometry").alias("parts"), F.round(_total(F.col("geometry")), 6).alias("area"))


_TOUCHING = _values([(a, b) for a, b in ((0, 1), (1, 0), (0, -1), (-1, 0))], "dr, dc")


@query("united_by_class", f"""
WITH RECURSIVE shapes AS (SELECT *, label_id % 3 AS class_id FROM boxes), m AS (SELECT DISTINCT class_id, CAST(y AS BIGINT) AS r, CAST(x AS BIGINT) AS c FROM shapes, {PIXELS} WHERE {_inside(0)}),
e AS (SELECT a.class_id, a.r * 2147483648 + a.c AS ka, b.r * 2147483648 + b.c AS kb FROM m a, {_TOUCHING} JOIN m b ON b.class_id = a.class_id AND b.r = a.r + dr AND b.c = a.c + dc),
t(class_id, x, root) AS (SELECT class_id, label_id * 0 + min(r * 2147483648 + c), min(r * 2147483648 + c) FROM (SELECT m.class_id, m.r, m.c, s.label_id FROM m JOIN shapes s ON s.class_id = m.class_id AND m.c + 0.5 > x0 AND m.c + 0.5 < x1 AND m.r + 0.5 > y0 AND m.r + 0.5 < y1) GROUP BY class_id, label_id
 UNION SELECT e.class_id, e.kb, t.root FROM t JOIN e ON e.class_id = t.class_id AND e.ka = t.x WHERE t.root <= e.kb),
k AS (SELECT class_id, x, min(root) AS label FROM t GROUP BY class_id, x)
SELECT CAST(class_id AS BIGINT) AS class_id, CAST(label AS BIGINT) AS label, CAST(count(*) AS DOUBLE) AS area FROM k GROUP BY class_id, label""")
def united_by_class(spark, d):
    """Overlapping boxes of each class as the polygons of their union."""
    rows = _boxes(spark, d).select((F.col("label_id") % 3).cast("long").alias("class_id"), F.array(_box()).alias("rings"))
    out = shapes.united_cells(rows, ["class_id"])
    return out.select("class_id", "label", geometry.polygon_area(F.col("rings")).alias("area"))


#: Boxes in sixteenths of a unit, and the share of the plane that those of a group cover: cells between their sides.
_ODD = "SELECT label_id, x0 + label_id % 16 / 16.0 AS x0, y0 + label_id % 5 / 4.0 AS y0, x1 + label_id % 3 / 2.0 AS x1, y1 + label_id % 7 / 8.0 AS y1 FROM boxes"
_COVER = """xs AS (SELECT g, x, lead(x) OVER (PARTITION BY g ORDER BY x) AS to_x, row_number() OVER (PARTITION BY g ORDER BY x) AS i FROM (SELECT g, x0 AS x FROM o UNION SELECT g, x1 FROM o)),
ys AS (SELECT g, y, lead(y) OVER (PARTITION BY g ORDER BY y) AS to_y, row_number() OVER (PARTITION BY g ORDER BY y) AS j FROM (SELECT g, y0 AS y FROM o UNION SELECT g, y1 FROM o)),
cells AS (SELECT DISTINCT xs.g, i * 100000 + j AS k, (to_x - x) * (to_y - y) AS size FROM o JOIN xs ON xs.g = o.g AND x >= x0 AND to_x <= x1 JOIN ys ON ys.g = o.g AND y >= y0 AND to_y <= y1)"""
_PARTS = f"""{_COVER},
e AS (SELECT a.g, a.k AS ka, b.k AS kb FROM cells a, (VALUES (1), (-1), (100000), (-100000)) s(d) JOIN cells b ON b.g = a.g AND b.k = a.k + d),
l(g, k, root) AS (SELECT g, k, k FROM cells UNION SELECT e.g, e.kb, l.root FROM l JOIN e ON e.g = l.g AND e.ka = l.k WHERE l.root < e.kb),
p AS (SELECT c.g, c.k, c.size, min(l.root) AS part FROM cells c JOIN l ON l.g = c.g AND l.k = c.k GROUP BY ALL)"""


def _odd_boxes(spark, d):
    """The boxes moved by fractions of a unit, each side by its own."""
    corner = lambda c, part: F.col(c) + part
    k = F.col("label_id")
    x0, y0, x1, y1 = corner("x0", k % 16 / 16), corner("y0", k % 5 / 4), corner("x1", k % 3 / 2), corner("y1", k % 7 / 8)
    return _boxes(spark, d).select("label_id", geometry.box_ring(x0, y0, x1, y1).alias("ring"))


@query("dissolved_tile_parts", f"""
WITH RECURSIVE o AS (SELECT *, label_id % 7 AS g FROM ({_ODD}) WHERE label_id % 5 <> 0), {_PARTS}
SELECT CAST(g AS BIGINT) AS tile, 'road' AS class_name, count(DISTINCT part) AS parts, round(CAST(sum(size) AS DOUBLE), 6) AS area FROM p GROUP BY g""")
def dissolved_tile_parts(spark, d):
    """The multipolygon that overlapping boxes make, for each tile and class; rows without a class go."""
    rows = _odd_boxes(spark, d).select(
        (F.col("label_id") % 7).alias("source_tile"), F.when(F.col("label_id") % 5 != 0, "road").alias("class_name"),
        F.lit(None).cast("double").alias("confidence"), F.array(F.array("ring")).alias("geometry"),
    )
    out = features.dissolve_parts(rows, cell=96.0)
    return out.select(F.col("source_tile").cast("long").alias("tile"), "class_name", F.size("geometry").cast("long").alias("parts"), F.round(_total(F.col("geometry")), 6).alias("area"))


@query("united_polygons", f"""
WITH RECURSIVE o AS (SELECT *, CASE WHEN label_id % 4 < 3 THEN label_id % 4 END AS c, coalesce(label_id % 4, 3) AS g FROM ({_ODD})), {_PARTS}
SELECT CAST(CASE WHEN g < 3 THEN g END AS BIGINT) AS class_id, round(CAST(area AS DOUBLE), 6) AS area, count(*) AS parts
FROM (SELECT g, part, sum(size) AS area FROM p GROUP BY g, part) GROUP BY g, area""")
def united_polygons(spark, d):
    """Each part of the union of a class's polygons, whatever their coordinates; boxes without a class are one, too."""
    rows = _odd_boxes(spark, d).select(F.when(F.col("label_id") % 4 < 3, F.col("label_id") % 4).cast("long").alias("class_id"), F.array("ring").alias("rings"))
    out = overlay.united(rows, ["class_id"], cell=64.0).select("class_id", F.round(geometry.polygon_area(F.col("rings")), 6).alias("area"))
    return out.groupBy("class_id", "area").agg(F.count(F.lit(1)).alias("parts"))


@query("crossing_rings", """
SELECT label_id, 'cross' AS kind, CAST(2 AS INT) AS parts, CAST(2.0 * (x1 - x0) * (y1 - y0) - 2 * (x1 - x0 - 3.25) * (y1 - y0 - 2.5) AS DOUBLE) AS area FROM boxes
UNION ALL SELECT label_id, 'hole', CAST(2 AS INT), CAST((x1 - x0) * (y1 - y0) - 2.5 * (y1 - y0 - 4) + 1.75 * (y1 - y0 - 4) AS DOUBLE) FROM boxes
UNION ALL SELECT label_id, 'nested', CAST(2 AS INT), CAST((x1 - x0) * (y1 - y0) - (x1 - x0 - 2) * (y1 - y0 - 2) + (x1 - x0 - 5.5) * (y1 - y0 - 5.5) AS DOUBLE) FROM boxes""")
def crossing_rings(spark, d):
    """Polygons of two or three rings that cross, that reach over each other's border or lie in each other, made valid."""
    ring = lambda x0, y0, x1, y1: geometry.box_ring(*(F.expr(f"CAST({e} AS DOUBLE)") for e in (x0, y0, x1, y1)))
    whole = ring("x0", "y0", "x1", "y1")
    kinds = {
        "cross": [whole, ring("x0 + 3.25", "y0 + 2.5", "x1 + 3.25", "y1 + 2.5")],
        "hole": [whole, ring("x1 - 2.5", "y0 + 2", "x1 + 1.75", "y1 - 2")],
        "nested": [ring("x0 + 1", "y0 + 1", "x1 - 1", "y1 - 1"), whole, ring("x0 + 2.75", "y0 + 2.75", "x1 - 2.75", "y1 - 2.75")],
    }
    rows = overlay.spread(_boxes(spark, d)).select("label_id", F.explode(F.map_from_arrays(F.array(*map(F.lit, kinds)), F.array(*[F.array(*r) for r in kinds.values()]))).alias("kind", "rings"))
    out = overlay.repaired(rows)
    return out.select("label_id", "kind", F.size("geometry").alias("parts"), F.round(_total(F.col("geometry")), 6).alias("area"))


@query("closed_gaps", """
SELECT label_id, CAST(CASE WHEN label_id % 9 / 4.0 <= 1.5 THEN 1 ELSE 2 END AS INT) AS joined, CAST((x1 - x0 - 1.5) * (y1 - y0 - 1.5) AS DOUBLE) AS shrunk, CAST(1 AS INT) AS opened FROM boxes""")
def closed_gaps(spark, d):
    """Two boxes apart by up to two units: grown and shrunk by 0.75 they are one up to a gap of 1.5; a box shrunk by as
    much, and a box with a thin spike shrunk and grown, which takes the spike off."""
    x0, y0, x1, y1 = (F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1"))
    gap, width = F.col("label_id") % 9 / 4.0, x1 - x0
    pair = F.array(geometry.box_ring(x0, y0, x1, y1), geometry.box_ring(x1 + gap, y0, x1 + gap + width, y1))
    spiked = F.array(geometry.box_ring(x0, y0, x1, y1), geometry.box_ring(x1, y0 + 1, x1 + 4, y0 + 1.5))
    rows = overlay.spread(_boxes(spark, d)).select("label_id", "x1", pair.alias("pair"), F.array(geometry.box_ring(x0, y0, x1, y1)).alias("one"), spiked.alias("spiked"))
    out = overlay.buffered(rows, [0.75, -0.75], "pair", "closed")
    out = overlay.buffered(overlay.buffered(out, [-0.75], "one", "small"), [-0.5, 0.5], "spiked", "open")
    wide = F.array_max(F.transform(F.get(F.get("open", F.lit(0)), F.lit(0)), lambda p: p["x"])) > x1 + 0.1
    return out.select("label_id", F.size("closed").alias("joined"), F.round(_total(F.col("small")), 6).alias("shrunk"), (F.size("open") + wide.cast("int")).alias("opened"))


@query("simplified_rings", "SELECT label_id, 5 AS points, CAST((x1 - x0) * (y1 - y0) AS DOUBLE) AS area FROM boxes")
def simplified_rings(spark, d):
    """Boxes with a point in the middle of each side, which simplifying takes out again."""
    x0, y0, x1, y1 = (F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1"))
    mx, my = (x0 + x1) / 2, (y0 + y1) / 2
    ring = F.array(*[geometry.point(x, y) for x, y in ((x0, y0), (mx, y0), (x1, y0), (x1, my), (x1, y1), (mx, y1), (x0, y1), (x0, my), (x0, y0))])
    out = shapes.simplified(_boxes(spark, d).select("label_id", F.array(ring).alias("rings")), 0.25)
    return out.select("label_id", F.size(F.get("rings", F.lit(0))).alias("points"), geometry.polygon_area(F.col("rings")).alias("area"))


@query("turned_rectangles", "SELECT label_id, CAST((x1 - x0) * (y1 - y0) AS DOUBLE) AS area, 5 AS points, 5 AS regular_points, CAST((x1 - x0) * (y1 - y0) AS DOUBLE) AS regular_area FROM boxes")
def turned_rectangles(spark, d):
    """Boxes turned by an angle of their own: the smallest rectangle and the regularised polygon are the box again."""
    start = _boxes(spark, d).withColumn("ring", _box()).withColumn("middle", geometry.centroid(F.col("ring")))
    turned = start.select("label_id", F.array(geometry.rotated(F.col("ring"), (F.col("label_id") % 80).cast("double"), F.col("middle"))).alias("rings"))
    kept = shapes.regularized(turned, 0.05).withColumnRenamed("rings", "regular")
    out = shapes.rectangularized(turned, 0.9).join(kept, "label_id")
    first = lambda c: F.size(F.get(c, F.lit(0)))
    return out.select(
        "label_id", F.round(geometry.polygon_area(F.col("rings")), 3).alias("area"), first("rings").alias("points"),
        first("regular").alias("regular_points"), F.round(geometry.polygon_area(F.col("regular")), 3).alias("regular_area"),
    )


_CROSS = _values([(0, 0), (0, 1), (1, 0), (0, -1), (-1, 0)], "dr, dc")


@query("smoothed_mask", f"""
WITH g AS (SELECT DISTINCT tile_id, r + dr AS r, c + dc AS c FROM raster, {_CROSS} WHERE v >= 150)
SELECT q.tile_id, q.r, q.c, CAST(count(g.r) = 5 AS INT) AS mask FROM raster q, {_CROSS} LEFT JOIN g ON g.tile_id = q.tile_id AND g.r = q.r + dr AND g.c = q.c + dc GROUP BY q.tile_id, q.r, q.c""")
def smoothed_mask(spark, d):
    return morphology.smoothed(_mask(spark, d, 150), 1)


@query("merged_mosaic_polygons", """
WITH RECURSIVE m AS (SELECT DISTINCT CAST(r AS BIGINT) AS gr, CAST(tile_id * 48 + c AS BIGINT) AS gc FROM raster WHERE v >= 120),
e AS (SELECT a.gr * 2147483648 + a.gc AS ka, b.gr * 2147483648 + b.gc AS kb FROM m a, (VALUES (0, 1), (1, 0), (0, -1), (-1, 0)) t(dr, dc) JOIN m b ON b.gr = a.gr + dr AND b.gc = a.gc + dc),
l(x, root) AS (SELECT gr * 2147483648 + gc, gr * 2147483648 + gc FROM m UNION SELECT e.kb, l.root FROM l JOIN e ON e.ka = l.x WHERE l.root < e.kb),
k AS (SELECT x, min(root) AS label FROM l GROUP BY x)
SELECT 'road' AS class_name, label, CAST(count(*) AS DOUBLE) AS area FROM k GROUP BY label""")
def merged_mosaic_polygons(spark, d):
    """The masks of overlapping tiles as one set of polygons, outlined block by block and joined at the blocks' sides."""
    ones = table(spark, d, "raster").filter("v >= 120").selectExpr("CAST(r AS BIGINT) AS gr", "CAST(tile_id * 48 + c AS BIGINT) AS gc")
    labelled = morphology.mosaic_components(ones).withColumn("class_name", F.lit("road"))
    return shapes.merged_polygons(labelled).select("class_name", "label", geometry.polygon_area(F.col("rings")).alias("area"))


@query("overlapping_boxes", "SELECT a.label_id AS a, b.label_id AS b FROM boxes a JOIN boxes b ON a.label_id < b.label_id AND a.x0 <= b.x1 AND a.x1 >= b.x0 AND a.y0 <= b.y1 AND a.y1 >= b.y0")
def overlapping_boxes(spark, d):
    """Pairs of boxes that meet, found on grid cells."""
    left = _boxes(spark, d).select(
        F.col("label_id").alias("a"), F.col("x0").alias("col_off"), F.col("y0").alias("row_off"),
        (F.col("x1") - F.col("x0")).alias("win_width"), (F.col("y1") - F.col("y0")).alias("win_height"),
    )
    pairs = labels.tile_label_join(left, _boxes(spark, d), 64)
    return pairs.filter("a < label_id").select("a", F.col("label_id").alias("b"))


_ELL = [(200.0, 150.0, 420.0, 330.0), (420.0, 150.0, 900.0, 200.0)]  # an L of two boxes that share a side


@query("windows_in_polygon", f"WITH {GRID} SELECT scene_id, tile_idx FROM grid WHERE EXISTS (SELECT 1 FROM {_values(_ELL, 'x0, y0, x1, y1')} WHERE col_off <= x1 AND col_off + win_width >= x0 AND row_off <= y1 AND row_off + win_height >= y0)")
def windows_in_polygon(spark, d):
    """Windows that meet an L-shaped area, of scenes with a pixel a unit and north up."""
    points = [(200, 150), (900, 150), (900, 200), (420, 200), (420, 330), (200, 330), (200, 150)]
    area = spark.createDataFrame([([[[(float(x), float(-y)) for x, y in points]]],)], "geometry array<array<array<struct<x:double,y:double>>>>")
    unit = F.struct(*[F.lit(v).alias(k) for k, v in zip("abcdef", (1.0, 0.0, 0.0, 0.0, -1.0, 0.0), strict=True)])
    grid = windows.window_grid(table(spark, d, "scenes"))
    return windows.touching_polygons(grid, unit, area, cell=1024.0).select("scene_id", "tile_idx")


@query("window_transforms", f"WITH {GRID} SELECT scene_id, tile_idx, CAST(0.5 AS DOUBLE) AS a, CAST(353496.0 + col_off * 0.5 AS DOUBLE) AS c, CAST(3864754.0 - row_off * 0.5 AS DOUBLE) AS f FROM grid")
def window_transforms(spark, d):
    t = F.struct(*[F.lit(v).alias(k) for k, v in zip("abcdef", (0.5, 0.0, 353496.0, 0.0, -0.5, 3864754.0), strict=True)])
    moved = windows.window_grid(table(spark, d, "scenes")).withColumn("t", windows.window_transform(t))
    return moved.select("scene_id", "tile_idx", "t.a", "t.c", "t.f")


@query("label_extent", "SELECT greatest(CAST(min(x0) - 200 AS DOUBLE), -180) AS west, greatest(CAST(min(y0) - 100 AS DOUBLE), -90) AS south, least(CAST(max(x1) - 200 AS DOUBLE), 180) AS east, least(CAST(max(y1) - 100 AS DOUBLE), 90) AS north FROM boxes")
def label_extent(spark, d):
    ring = geometry.box_ring(F.col("x0") - 200, F.col("y0") - 100, F.col("x1") - 200, F.col("y1") - 100)
    rows = _boxes(spark, d).select(F.array(F.array(ring)).alias("geometry"))
    return features.label_extent(rows).select("bounds.*")


@query("extent_sources", "SELECT source_tile, CASE CAST(substr(source_tile, 6) AS INT) % 4 WHEN 0 THEN 'imagery' WHEN 1 THEN 'imagery' WHEN 2 THEN 'labels' END AS source FROM (SELECT DISTINCT source_tile FROM detections)")
def extent_sources(spark, d):
    """Spellings of the two kinds of extent; others are null."""
    rows = table(spark, d, "detections").select("source_tile").distinct()
    spelt = F.element_at(F.array(*map(F.lit, (" COG ", "Raster", "label-package", "moon"))), F.substring("source_tile", 6, 9).cast("int") % 4 + 1)
    return rows.select("source_tile", features.extent_source(spelt).alias("source"))


@query("load_slugs", "SELECT seq, strftime(CAST(loaded_at AS TIMESTAMP), '%Y%m%dT%H%M%SZ') AS slug FROM loads")
def load_slugs(spark, d):
    return table(spark, d, "loads").select("seq", features.time_slug(F.col("loaded_at").cast("timestamp")).alias("slug"))


@query("polygon_parts", "SELECT label_id, CAST((x1 - x0) * (y1 - y0) AS DOUBLE) AS area FROM boxes UNION ALL SELECT label_id, CAST((x1 - x0 - 4) * (y1 - y0 - 4) AS DOUBLE) FROM boxes WHERE x1 - x0 >= 12 AND y1 - y0 >= 12")
def polygon_parts(spark, d):
    """Multipolygons of one or two parts, a row for each part; empty and null ones go."""
    shape = F.when(F.expr(HOLED), F.array(F.array(_box()), F.array(_box(2)))).otherwise(F.array(F.array(_box())))
    rows = _boxes(spark, d).select("label_id", shape.alias("geometry"))
    none = rows.limit(3).select("label_id", F.lit(None).cast(dict(rows.dtypes)["geometry"]).alias("geometry"))
    parts = rows.unionByName(none).select("label_id", F.explode("geometry").alias("rings"))
    return parts.select("label_id", geometry.polygon_area(F.col("rings")).alias("area"))


@query("chip_export", f"""
WITH g AS (SELECT label_id, (x1 - x0) * (y1 - y0) AS positive_pixels FROM boxes)
SELECT count(*) AS chips, count(*) FILTER (WHERE positive_pixels >= 300) AS positive FROM g""")
def chip_export(spark, d):
    """Every chip gets a split; those with enough pixels all stay, whatever the draws."""
    counted = _boxes(spark, d).select((F.col("label_id") % 9).alias("scene"), F.col("label_id").alias("chip_idx"), ((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))).alias("positive_pixels"))
    split = labels.chip_split(counted, 300, 0.5, 0.2, seed=13, scene="scene")
    return split.groupBy().agg(F.count(F.lit(1)).alias("chips"), F.count_if((F.col("positive_pixels") >= 300) & F.col("split").isin("train", "val")).alias("positive"))


@query("image_mask_pairs", "SELECT scene_id AS stem, width, height AS ones FROM scenes")
def image_mask_pairs(spark, d):
    scenes = table(spark, d, "scenes")
    masks = scenes.select(F.col("scene_id").cast("string").alias("stem"), F.col("height").alias("ones"))
    pairs = labels.paired_chips(scenes.select(F.col("scene_id").cast("string").alias("stem"), "width"), masks)
    return pairs.select(F.col("stem").cast("long").alias("stem"), "width", "ones")


@query("inferred_planes", """
SELECT tile_id, r, c, round(CASE WHEN hi > 1 OR lo < 0 THEN 1 / (1 + exp(-x)) ELSE x END, 4) AS p FROM
(SELECT *, min(x) OVER (PARTITION BY tile_id) AS lo, max(x) OVER (PARTITION BY tile_id) AS hi FROM
 (SELECT tile_id, r, c, (v / CASE WHEN m <= 1 THEN 1.0 WHEN m <= 255 THEN 255.0 ELSE m END + v / CASE WHEN m <= 1 THEN 1.0 WHEN m <= 255 THEN 255.0 ELSE m END) / 2 AS x
  FROM (SELECT tile_id, r, c, CAST(v AS DOUBLE) AS v, CAST(max(v) OVER (PARTITION BY tile_id) AS DOUBLE) AS m FROM raster)))""")
def inferred_planes(spark, d):
    """Tiles of two equal bands through a model that takes the mean of the bands, over all flips."""
    bands = table(spark, d, "raster").select("tile_id", "r", "c", F.explode(F.array(F.lit(0), F.lit(1))).alias("band"), F.col("v").cast("double").alias("v"))
    planes = inference.infer(inference.blocked_form(bands), lambda x: x.mean(axis=1, keepdims=True), flips=["none", "hflip", "vflip", "hvflip"])
    out = inference.long_form(planes)
    return out.select("tile_id", F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c"), F.round(F.col("p").cast("double"), 4).alias("p"))


@query("vectorized_masks", f"{_components(50, False)}, k AS (SELECT tile_id, label, count(*) AS n FROM lab GROUP BY ALL HAVING count(*) >= 6) SELECT CAST(tile_id AS VARCHAR) AS source_tile, 'road' AS class_name, count(*) AS parts, CAST(sum(n) AS DOUBLE) AS area FROM k GROUP BY tile_id")
def vectorized_masks(spark, d):
    """Masks to features: regions of six pixels and more, one multipolygon a tile and class."""
    options = vectorizing.Options(min_area=6.0, cell=32.0)
    rows = vectorizing.mask_polygons(_mask(spark, d, 50), options).withColumn("class_name", F.lit("road"))
    out = vectorizing.vectorized(rows, options)
    return out.select("source_tile", "class_name", F.size("geometry").cast("long").alias("parts"), F.round(_total(F.col("geometry")), 6).alias("area"))


@query("vectorized_mosaic", f"""{_components(100, False)}, big AS (SELECT tile_id, label FROM lab GROUP BY ALL HAVING count(*) >= 4),
mm AS (SELECT DISTINCT CAST(r AS BIGINT) AS gr, CAST(tile_id * 48 + c AS BIGINT) AS gc FROM lab SEMI JOIN big ON big.tile_id = lab.tile_id AND big.label = lab.label),
ee AS (SELECT a.gr * 2147483648 + a.gc AS ka, b.gr * 2147483648 + b.gc AS kb FROM mm a, (VALUES (0, 1), (1, 0), (0, -1), (-1, 0)) t(dr, dc) JOIN mm b ON b.gr = a.gr + dr AND b.gc = a.gc + dc),
ll(x, root) AS (SELECT gr * 2147483648 + gc, gr * 2147483648 + gc FROM mm UNION SELECT ee.kb, ll.root FROM ll JOIN ee ON ee.ka = ll.x WHERE ll.root < ee.kb),
kk AS (SELECT x, min(root) AS part FROM ll GROUP BY x)
SELECT 'merged' AS source_tile, area, count(*) AS features FROM (SELECT part, CAST(count(*) AS DOUBLE) AS area FROM kk GROUP BY part) GROUP BY area""")
def vectorized_mosaic(spark, d):
    """Overlapping tiles' regions of four pixels and more as the polygons of their union, each a feature."""
    options = vectorizing.Options(min_area=4.0, dissolve_overlaps=True, cell=64.0)
    moved = F.transform("rings", lambda ring: F.transform(ring, lambda p: F.struct((p["x"] + F.col("source_tile") * 48).alias("x"), p["y"].alias("y"))))
    rows = vectorizing.mask_polygons(_mask(spark, d, 100), options).withColumn("rings", moved).withColumn("class_name", F.lit("road"))
    out = vectorizing.vectorized(rows, options).select("source_tile", F.round(_total(F.col("geometry")), 6).alias("area"))
    return out.groupBy("source_tile", "area").agg(F.count(F.lit(1)).alias("features"))
