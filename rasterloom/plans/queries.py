"""The registered queries of the engine's operators and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rasterloom.functions import crs, geometry
from rasterloom.operators import blocks, features, labels, metrics, morphology, pixels, shapes, windows
from rasterloom.plans.fixtures import table, with_fixtures
from rasterloom.sources import osm

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
SCENE = 512  # pixels of the scene that the label boxes lie in
THRESHOLDS = [0.45, 0.5, 0.55, 0.6, 0.65]
AREAS = [(0.0, 0.0, 300.0, 200.0), (1500.0, 900.0, 2600.0, 1400.0)]


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = with_fixtures(sql)
        return f

    return register


def _values(rows, names: str) -> str:
    return f"(VALUES {', '.join('(' + ', '.join(map(str, r)) + ')' for r in rows)}) t({names})"


GRID = """
xs AS (SELECT *, unnest(list_distinct(list_append(range(0, greatest(width - tile_size, 0) + 1, tile_size - overlap), greatest(width - tile_size, 0)))) AS col_off FROM scenes),
xy AS (SELECT *, unnest(list_distinct(list_append(range(0, greatest(height - tile_size, 0) + 1, tile_size - overlap), greatest(height - tile_size, 0)))) AS row_off FROM xs),
grid AS (SELECT scene_id, width, height, tile_size, overlap,
  CAST(row_number() OVER (PARTITION BY scene_id ORDER BY row_off, col_off) - 1 AS INT) AS tile_idx,
  CAST(col_off AS INT) AS col_off, CAST(row_off AS INT) AS row_off,
  CAST(least(tile_size, width - col_off) AS INT) AS win_width, CAST(least(tile_size, height - row_off) AS INT) AS win_height FROM xy)
"""


@query("window_grid", f"WITH {GRID} SELECT * FROM grid")
def window_grid(spark, d):
    return windows.window_grid(table(spark, d, "scenes"))


@query("window_count_by_scene", f"WITH {GRID} SELECT scene_id, count(*) AS tiles FROM grid GROUP BY scene_id")
def window_count_by_scene(spark, d):
    return window_grid(spark, d).groupBy("scene_id").agg(F.count(F.lit(1)).alias("tiles"))


@query("partial_tiles", f"WITH {GRID} SELECT scene_id, tile_idx, win_width, win_height FROM grid WHERE win_width < tile_size OR win_height < tile_size")
def partial_tiles(spark, d):
    return window_grid(spark, d).filter(windows.is_partial()).select("scene_id", "tile_idx", "win_width", "win_height")


_HIT = f"EXISTS (SELECT 1 FROM {_values(AREAS, 'x0, y0, x1, y1')} WHERE col_off <= x1 AND col_off + win_width >= x0 AND row_off <= y1 AND row_off + win_height >= y0)"


@query("aoi_tile_semi_join", f"WITH {GRID} SELECT scene_id, tile_idx, col_off, row_off FROM grid WHERE {_HIT}")
def aoi_tile_semi_join(spark, d):
    return windows.touching(window_grid(spark, d), AREAS).select("scene_id", "tile_idx", "col_off", "row_off")


@query("tile_index_after_filter", f"WITH {GRID} SELECT scene_id, CAST(row_number() OVER (PARTITION BY scene_id ORDER BY row_off, col_off) - 1 AS INT) AS tile_idx, col_off, row_off FROM grid WHERE {_HIT}")
def tile_index_after_filter(spark, d):
    return windows.renumbered(windows.touching(window_grid(spark, d), AREAS)).select("scene_id", "tile_idx", "col_off", "row_off")


@query("window_bounds", f"WITH {GRID} SELECT scene_id, tile_idx, CAST(353496.0 + col_off * 0.5 AS DOUBLE) AS west, CAST(3864754.0 - (row_off + win_height) * 0.5 AS DOUBLE) AS south, CAST(353496.0 + (col_off + win_width) * 0.5 AS DOUBLE) AS east, CAST(3864754.0 - row_off * 0.5 AS DOUBLE) AS north FROM grid")
def window_bounds(spark, d):
    t = F.struct(*[F.lit(v).alias(k) for k, v in zip("abcdef", (0.5, 0.0, 353496.0, 0.0, -0.5, 3864754.0), strict=True)])
    return window_grid(spark, d).select("scene_id", "tile_idx", windows.window_bounds(t).alias("b")).select("scene_id", "tile_idx", "b.*")


@query("centred_crop", """
SELECT scene_id, CAST(greatest(least(scene_id % 900 - least(1024, width) // 2, greatest(width - least(1024, width), 0)), 0) AS INT) AS crop_x,
  CAST(greatest(least(scene_id % 700 - least(1024, height) // 2, greatest(height - least(1024, height), 0)), 0) AS INT) AS crop_y,
  least(1024, width) AS crop_width, least(1024, height) AS crop_height FROM scenes""")
def centred_crop(spark, d):
    return table(spark, d, "scenes").select("scene_id", *windows.centred_crop(1024, F.col("scene_id") % 900, F.col("scene_id") % 700))


@query("band_max_scale", """
SELECT tile_id, r, c, round((CASE WHEN m <= 1 THEN v WHEN m <= 255 THEN v / 255.0 ELSE v / m END - 0.25) / 0.5, 6) AS x
FROM (SELECT tile_id, r, c, CAST(v AS DOUBLE) AS v, CAST(max(v) OVER (PARTITION BY tile_id) AS DOUBLE) AS m FROM raster)""")
def band_max_scale(spark, d):
    scaled = pixels.normalised(pixels.imagery_scale(F.col("v")), 0.25, 0.5)
    return table(spark, d, "raster").select("tile_id", "r", "c", F.round(scaled, 6).alias("x"))


@query("sigmoid_gate", """
SELECT tile_id, r, c, round(CASE WHEN lo < 0 OR hi > 1 THEN 1 / (1 + exp(-x)) ELSE x END, 6) AS p
FROM (SELECT *, min(x) OVER (PARTITION BY tile_id) lo, max(x) OVER (PARTITION BY tile_id) hi FROM
      (SELECT tile_id, r, c, CASE WHEN tile_id % 2 = 0 THEN v / 100.0 ELSE abs(v) / 1000.0 END AS x FROM raster))""")
def sigmoid_gate(spark, d):
    x = F.when(F.col("tile_id") % 2 == 0, F.col("v") / 100.0).otherwise(F.abs("v") / 1000.0)
    return table(spark, d, "raster").withColumn("x", x).select("tile_id", "r", "c", F.round(pixels.probability_gate(F.col("x")), 6).alias("p"))


@query("softmax_foreground", """
SELECT tile_id, l_linenumber, round(CASE WHEN lo >= 0 AND hi <= 1 AND sums THEN z1 ELSE exp(z1 - greatest(z0, z1)) / (exp(z0 - greatest(z0, z1)) + exp(z1 - greatest(z0, z1))) END, 6) AS p
FROM (SELECT *, min(least(z0, z1)) OVER w AS lo, max(greatest(z0, z1)) OVER w AS hi, bool_and(abs(z0 + z1 - 1) <= 1e-3 + 1e-5) OVER w AS sums FROM logits WINDOW w AS (PARTITION BY tile_id))""")
def softmax_foreground(spark, d):
    p = pixels.foreground_probability(F.col("z0"), F.col("z1"))
    return table(spark, d, "logits").select("tile_id", "l_linenumber", F.round(p, 6).alias("p"))


_FLIPS = _values([(0, 0, 0), (1, 0, 1), (2, 1, 0), (3, 1, 1)], "aug, fv, fh")


@query("tta_flip_mean", f"""
WITH sized AS (SELECT *, max(r) OVER (PARTITION BY tile_id) + 1 AS h, max(c) OVER (PARTITION BY tile_id) + 1 AS w FROM raster),
f AS (SELECT tile_id, aug, fv, fh, h, w, v, CASE WHEN fv = 1 THEN h - 1 - r ELSE r END AS r, CASE WHEN fh = 1 THEN w - 1 - c ELSE c END AS c FROM sized, {_FLIPS}),
p AS (SELECT *, v - coalesce(lag(v) OVER (PARTITION BY tile_id, aug, r ORDER BY c), 0) AS p FROM f)
SELECT tile_id, CAST(CASE WHEN fv = 1 THEN h - 1 - r ELSE r END AS INT) AS r, CAST(CASE WHEN fh = 1 THEN w - 1 - c ELSE c END AS INT) AS c, avg(p) AS p FROM p GROUP BY 1, 2, 3""")
def tta_flip_mean(spark, d):
    def steps(df):  # a model that sees its left neighbour
        before = F.lag("v").over(Window.partitionBy("tile_id", "aug", "r").orderBy("c"))
        return df.withColumn("p", F.col("v") - F.coalesce(before, F.lit(0)))

    return pixels.flip_mean(table(spark, d, "raster"), steps, ["none", "hflip", "vflip", "hvflip"])


@query("nearest_resize", """
WITH s AS (SELECT tile_id, max(r) + 1 AS h, max(c) + 1 AS w FROM raster GROUP BY tile_id),
g AS (SELECT tile_id, CAST(i AS INT) AS r, CAST(j AS INT) AS c, CAST(round_even(CAST(i * ((h - 1) / 39.0) AS DOUBLE), 0) AS INT) AS sr, CAST(round_even(CAST(j * ((w - 1) / 47.0) AS DOUBLE), 0) AS INT) AS sc FROM s, range(40) a(i), range(48) b(j))
SELECT g.tile_id, g.r, g.c, v FROM g JOIN raster q ON g.tile_id = q.tile_id AND q.r = sr AND q.c = sc""")
def nearest_resize(spark, d):
    return pixels.resize_nearest(table(spark, d, "raster"), 40, 48)


ORACLE_BILINEAR = """
WITH s AS (SELECT tile_id, max(r) + 1 AS h, max(c) + 1 AS w FROM raster GROUP BY tile_id),
x AS (SELECT q.tile_id, q.r, CAST(j AS INT) AS c, a.v + (b.v - a.v) * (j * ((w - 1) / 95.0) - floor(j * ((w - 1) / 95.0))) AS v
      FROM s JOIN (SELECT DISTINCT tile_id, r FROM raster) q USING (tile_id), range(96) t(j)
      JOIN raster a ON a.tile_id = q.tile_id AND a.r = q.r AND a.c = floor(j * ((w - 1) / 95.0))
      JOIN raster b ON b.tile_id = q.tile_id AND b.r = q.r AND b.c = least(floor(j * ((w - 1) / 95.0)) + 1, w - 1))
SELECT s.tile_id, CAST(i AS INT) AS r, a.c, round(a.v + (b.v - a.v) * (i * ((h - 1) / 79.0) - floor(i * ((h - 1) / 79.0))), 6) AS v
FROM s, range(80) t(i) JOIN x a ON a.tile_id = s.tile_id AND a.r = floor(i * ((h - 1) / 79.0))
JOIN x b ON b.tile_id = s.tile_id AND b.c = a.c AND b.r = least(floor(i * ((h - 1) / 79.0)) + 1, h - 1)"""


@query("bilinear_resize", ORACLE_BILINEAR)
def bilinear_resize(spark, d):
    return pixels.resize_bilinear(table(spark, d, "raster"), 80, 96).withColumn("v", F.round("v", 6))


P = "least(greatest(500 + v, 0), 1000)"


def _p(spark, d):
    return table(spark, d, "raster").withColumn("p", F.least(F.greatest(500 + F.col("v"), F.lit(0)), F.lit(1000)))


@query("threshold_mask", f"SELECT tile_id, r, c, CAST(CAST({P} / 1000.0 AS FLOAT) >= CAST(0.55 AS FLOAT) AS INT) AS mask FROM raster")
def threshold_mask(spark, d):
    return _p(spark, d).select("tile_id", "r", "c", pixels.thresholded(F.col("p") / 1000.0, 0.55).alias("mask"))


@query("mask_coverage", "SELECT tile_id, count(*) AS pixels, count(*) FILTER (WHERE v >= 50) AS ones, avg(CAST(v >= 50 AS DOUBLE)) AS share, avg(CAST(v >= 50 AS DOUBLE)) > 0.35 AS skipped FROM raster GROUP BY tile_id")
def mask_coverage(spark, d):
    return pixels.coverage(_mask(spark, d, 50), 0.35)


@query("threshold_sweep", f"""
SELECT threshold, 't' || lpad(CAST(CAST(round_even(threshold * 100, 0) AS INT) AS VARCHAR), 3, '0') AS tag, tile_id, count(*) FILTER (WHERE CAST({P} / 1000.0 AS FLOAT) >= CAST(threshold AS FLOAT)) AS ones
FROM raster, (SELECT CAST(x AS DOUBLE) AS threshold FROM {_values([(t,) for t in THRESHOLDS], 'x')}) GROUP BY ALL""")
def threshold_sweep(spark, d):
    swept = pixels.sweep(_p(spark, d).withColumn("p", F.col("p") / 1000.0), THRESHOLDS)
    return swept.groupBy("threshold", "tag", "tile_id").agg(F.sum("mask").alias("ones"))


@query("threshold_tags", "SELECT DISTINCT CAST(area_m2 AS DOUBLE) / 80 AS threshold, 't' || lpad(CAST(CAST(round_even(CAST(CAST(area_m2 AS DOUBLE) / 80 * 100 AS DOUBLE), 0) AS INT) AS VARCHAR), 3, '0') AS tag FROM detections")
def threshold_tags(spark, d):
    rows = table(spark, d, "detections").select((F.col("area_m2").cast("double") / 80).alias("threshold")).distinct()
    return rows.withColumn("tag", pixels.threshold_tag(F.col("threshold")))


@query("overlap_mean_mosaic", f"SELECT r AS gr, tile_id * 48 + c AS gc, sum({P}) / count(*) AS p, count(*) AS n FROM raster GROUP BY 1, 2")
def overlap_mean_mosaic(spark, d):
    return pixels.overlap_mean(_p(spark, d).select(F.col("r").alias("gr"), (F.col("tile_id") * 48 + F.col("c")).alias("gc"), "p"))


@query("multi_scale_mean", """
WITH small AS (SELECT tile_id, r, c, CAST(v AS DOUBLE) + 7 AS v FROM raster WHERE r % 2 = 0 AND c % 2 = 0),
s AS (SELECT tile_id, max(r) + 1 AS h, max(c) + 1 AS w, max(r) // 2 + 1 AS sh, max(c) // 2 + 1 AS sw FROM raster GROUP BY tile_id),
g AS (SELECT q.tile_id, q.r, q.c, q.v, sh, sw, CASE WHEN h = 1 THEN 0 ELSE q.r * ((sh - 1) / CAST(h - 1 AS DOUBLE)) END AS y, CASE WHEN w = 1 THEN 0 ELSE q.c * ((sw - 1) / CAST(w - 1 AS DOUBLE)) END AS x FROM raster q JOIN s USING (tile_id)),
k AS (SELECT *, CAST(floor(y) AS INT) AS y0, CAST(floor(x) AS INT) AS x0, CAST(least(floor(y) + 1, sh - 1) AS INT) AS y1, CAST(least(floor(x) + 1, sw - 1) AS INT) AS x1 FROM g)
SELECT k.tile_id, k.r, k.c, round((k.v + (a.v + (b.v - a.v) * (x - x0)) + ((e.v + (f.v - e.v) * (x - x0)) - (a.v + (b.v - a.v) * (x - x0))) * (y - y0)) / 2, 6) AS v
FROM k JOIN small a ON a.tile_id = k.tile_id AND a.r = 2 * y0 AND a.c = 2 * x0 JOIN small b ON b.tile_id = k.tile_id AND b.r = 2 * y0 AND b.c = 2 * x1
JOIN small e ON e.tile_id = k.tile_id AND e.r = 2 * y1 AND e.c = 2 * x0 JOIN small f ON f.tile_id = k.tile_id AND f.r = 2 * y1 AND f.c = 2 * x1""")
def multi_scale_mean(spark, d):
    """Predictions of two sizes, the tile's own and one of every other row and column, for tiles of unequal heights."""
    raster = table(spark, d, "raster")
    half = raster.filter("r % 2 = 0 AND c % 2 = 0").selectExpr("tile_id", "CAST(r / 2 AS INT) AS r", "CAST(c / 2 AS INT) AS c", "v + 7 AS v")
    return pixels.scale_mean([raster, half]).withColumn("v", F.round("v", 6))


def _mask(spark, d, least: int):
    return table(spark, d, "raster").select("tile_id", "r", "c", (F.col("v") >= least).cast("int").alias("mask"))


def _ones(spark, d, least: int):
    return _mask(spark, d, least).filter("mask = 1").select("tile_id", "r", "c")


def _sizes(spark, d):
    return table(spark, d, "raster").groupBy("tile_id").agg((F.max("r") + 1).alias("height"), (F.max("c") + 1).alias("width"))


NEAR = _values([(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)], "dr, dc")


def _dilated(of: str) -> str:
    return f"SELECT DISTINCT m.tile_id, CAST(m.r + dr AS INT) AS r, CAST(m.c + dc AS INT) AS c FROM {of} m, {NEAR} SEMI JOIN raster q ON q.tile_id = m.tile_id AND q.r = m.r + dr AND q.c = m.c + dc"


def _eroded(of: str) -> str:
    return f"SELECT tile_id, CAST(rr AS INT) AS r, CAST(cc AS INT) AS c FROM (SELECT m.tile_id, m.r + dr AS rr, m.c + dc AS cc FROM {of} m, {NEAR}) GROUP BY ALL HAVING count(*) = 9"


@query("dilate", f"WITH m AS (SELECT tile_id, r, c FROM raster WHERE v >= 200), {'o AS (' + _dilated('m') + ')'} SELECT * FROM o")
def dilate(spark, d):
    return morphology.dilate(_ones(spark, d, 200), _sizes(spark, d))


@query("erode", f"WITH m AS (SELECT tile_id, r, c FROM raster WHERE v >= -150) {_eroded('m')}")
def erode(spark, d):
    return morphology.erode(_ones(spark, d, -150))


@query("close_mask", f"WITH m AS (SELECT tile_id, r, c FROM raster WHERE v >= 100), g AS ({_dilated('m')}) {_eroded('g')}")
def close_mask(spark, d):
    return morphology.close(_ones(spark, d, 100), _sizes(spark, d), 1)


def _components(least: int, eight: bool) -> str:
    near = _values([(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a or b) and (eight or not (a and b))], "dr, dc")
    return f"""WITH RECURSIVE m AS (SELECT tile_id, r, c, r * 64 + c AS id FROM raster WHERE v >= {least}),
    e AS (SELECT a.tile_id, a.id AS x, b.id AS y FROM m a, {near} JOIN m b ON b.tile_id = a.tile_id AND b.r = a.r + dr AND b.c = a.c + dc),
    l(tile_id, x, root) AS (SELECT tile_id, id, id FROM m UNION SELECT e.tile_id, e.y, l.root FROM l JOIN e ON e.tile_id = l.tile_id AND e.x = l.x WHERE l.root < e.y),
    lab AS (SELECT m.tile_id, m.r, m.c, k.label FROM m JOIN (SELECT tile_id, x, CAST(min(root) AS BIGINT) AS label FROM l GROUP BY tile_id, x) k ON k.tile_id = m.tile_id AND k.x = m.id)"""


@query("components4", f"{_components(50, False)} SELECT * FROM lab")
def components4(spark, d):
    return morphology.tile_components(_mask(spark, d, 50), 4)


@query("components8", f"{_components(80, True)} SELECT * FROM lab")
def components8(spark, d):
    return morphology.tile_components(_mask(spark, d, 80), 8)


@query("component_sizes", f"{_components(50, False)} SELECT pixels, count(*) AS components FROM (SELECT tile_id, label, count(*) AS pixels FROM lab GROUP BY ALL) GROUP BY pixels")
def component_sizes(spark, d):
    return features.component_sizes(components4(spark, d))


@query("region_box_and_area", f"{_components(50, False)} SELECT tile_id, label, count(*) AS pixels, CAST(count(*) * 0.25 AS DOUBLE) AS area, min(r) AS r0, min(c) AS c0, max(r) AS r1, max(c) AS c1 FROM lab GROUP BY tile_id, label")
def region_box_and_area(spark, d):
    return features.region_facts(components4(spark, d), 0.25)


@query("mask_region_report", f"""{_components(50, False)}
SELECT tile_id, count(*) AS regions, CAST(sum(n) AS BIGINT) AS pixels, max(n) AS largest FROM
(SELECT tile_id, label, count(*) AS n FROM lab WHERE tile_id IN (SELECT tile_id FROM raster GROUP BY tile_id HAVING avg(CAST(v >= 50 AS DOUBLE)) <= 0.36) GROUP BY ALL HAVING count(*) >= 3) GROUP BY tile_id""")
def mask_region_report(spark, d):
    masks = _mask(spark, d, 50)
    fine = pixels.coverage(masks, 0.36).filter("NOT skipped").select("tile_id")
    regions = features.region_facts(morphology.tile_components(masks.join(fine, "tile_id", "left_semi"), 4)).filter("pixels >= 3")
    return regions.groupBy("tile_id").agg(F.count(F.lit(1)).alias("regions"), F.sum("pixels").alias("pixels"), F.max("pixels").alias("largest"))


@query("mosaic_components", """
WITH RECURSIVE m AS (SELECT DISTINCT r AS gr, tile_id * 48 + c AS gc FROM raster WHERE v >= 120),
e AS (SELECT a.gr AS ar, a.gc AS ac, b.gr AS br, b.gc AS bc, CAST(a.gr AS BIGINT) * 2147483648 + a.gc AS ka, CAST(b.gr AS BIGINT) * 2147483648 + b.gc AS kb FROM m a, (VALUES (0, 1), (1, 0), (0, -1), (-1, 0)) t(dr, dc) JOIN m b ON b.gr = a.gr + dr AND b.gc = a.gc + dc),
l(x, root) AS (SELECT CAST(gr AS BIGINT) * 2147483648 + gc, CAST(gr AS BIGINT) * 2147483648 + gc FROM m UNION SELECT e.kb, l.root FROM l JOIN e ON e.ka = l.x WHERE l.root < e.kb),
k AS (SELECT x, min(root) AS label FROM l GROUP BY x)
SELECT CAST(gr AS BIGINT) AS gr, CAST(gc AS BIGINT) AS gc, label FROM m JOIN k ON x = CAST(gr AS BIGINT) * 2147483648 + gc""")
def mosaic_components(spark, d):
    """Every tile, in blocks of the operator's own size."""
    ones = table(spark, d, "raster").filter("v >= 120").select(F.col("r").cast("long").alias("gr"), (F.col("tile_id") * 48 + F.col("c")).cast("long").alias("gc"))
    return morphology.mosaic_components(ones)


def _sieve(size: int, values: str, source: str = "raster", least: int = 80) -> str:
    """Small components by bounded balls: one of fewer than ``size`` pixels is what size - 1 steps reach."""
    steps = "e1 AS (SELECT a.tile_id, a.id AS x, b.id AS y FROM m a, {n} JOIN m b ON b.tile_id = a.tile_id AND b.r = a.r + dr AND b.c = a.c + dc AND b.k = a.k)".format(n=NEAR)
    for k in range(2, size):
        steps += f", e{k} AS (SELECT DISTINCT p.tile_id, p.x, q.y FROM e{k - 1} p JOIN e1 q ON q.tile_id = p.tile_id AND q.x = p.y)"
    return f"""m AS (SELECT tile_id, r, c, r * 64 + c AS id, CAST(v >= {least} AS INT) AS k FROM {source}), {steps},
    small AS (SELECT tile_id, x FROM e{size - 1} GROUP BY ALL HAVING count(*) < {size}),
    big AS (SELECT m.* FROM m ANTI JOIN small s ON s.tile_id = m.tile_id AND s.x = m.id),
    touch AS (SELECT DISTINCT a.tile_id, a.id FROM m a, {NEAR} JOIN big b ON b.tile_id = a.tile_id AND b.r = a.r + dr AND b.c = a.c + dc AND b.k <> a.k),
    flip AS (SELECT DISTINCT s.tile_id, s.x FROM small s JOIN e{size - 1} b ON b.tile_id = s.tile_id AND b.x = s.x JOIN touch t ON t.tile_id = s.tile_id AND t.id = b.y),
    done AS (SELECT m.tile_id, m.r, m.c, CASE WHEN f.x IS NOT NULL AND k IN ({values}) THEN 1 - k ELSE k END AS mask FROM m LEFT JOIN flip f ON f.tile_id = m.tile_id AND f.x = m.id)"""


@query("remove_small_objects", f"WITH {_sieve(4, '1')} SELECT * FROM done")
def remove_small_objects(spark, d):
    return morphology.remove_small_objects(_mask(spark, d, 80), 4)


@query("fill_small_holes", f"WITH {_sieve(4, '0', least=-80)} SELECT * FROM done")
def fill_small_holes(spark, d):
    return morphology.fill_small_holes(_mask(spark, d, -80), 4)


@query("mask_cleanup", f"""WITH m0 AS (SELECT tile_id, r, c FROM raster WHERE v >= 200), g0 AS ({_dilated('m0')}), z0 AS ({_eroded('g0')}),
closed AS (SELECT q.tile_id, q.r, q.c, CASE WHEN z.r IS NULL THEN 0 ELSE 1 END AS v FROM raster q LEFT JOIN z0 z USING (tile_id, r, c)),
{_sieve(3, '1', 'closed', 1)} SELECT * FROM done""")
def mask_cleanup(spark, d):
    return morphology.cleanup(_mask(spark, d, 200), close_pixels=1, remove_objects=3)


_MOSAIC = "mo AS (SELECT r AS gr, tile_id * 48 + c AS gc, avg(v) AS v FROM raster GROUP BY 1, 2), area AS (SELECT max(gr) AS rows, max(gc) AS cols FROM mo)"
_CLOSED = f"""{_MOSAIC}, ones AS (SELECT gr, gc FROM mo WHERE v >= 100),
grown AS (SELECT DISTINCT gr + dr AS gr, gc + dc AS gc FROM ones, {NEAR}, area WHERE gr + dr BETWEEN 0 AND rows AND gc + dc BETWEEN 0 AND cols),
shrunk AS (SELECT y AS gr, x AS gc FROM (SELECT gr + dr AS y, gc + dc AS x FROM grown, {NEAR}) GROUP BY ALL HAVING count(*) = 9)"""


def _mosaic(spark, d, size: int):
    """The raster's tiles, each overlapping the next one by 16 columns, as the blocks of one mosaic."""
    rows = table(spark, d, "raster").groupBy("tile_id").agg(
        (F.max("r") + 1).alias("height"), (F.max("c") + 1).alias("width"), F.transform(F.sort_array(F.collect_list(F.struct("r", "c", "v"))), lambda x: x["v"].cast("float")).alias("values")
    )
    return blocks.mosaic_mean(rows.select(F.lit("s").alias("scene"), F.lit(0).alias("row_off"), (F.col("tile_id") * 48).alias("col_off"), "height", "width", "values"), size)


@query("blocked_mosaic_mean", f"WITH {_MOSAIC} SELECT CAST(gr AS BIGINT) AS gr, CAST(gc AS BIGINT) AS gc, v FROM mo")
def blocked_mosaic_mean(spark, d):
    """The mean of overlapping tiles, block by block."""
    return blocks.to_pixels(_mosaic(spark, d, 40), "<f4", 40).filter("v IS NOT NULL").select("gr", "gc", "v")


@query("blocked_close", f"WITH {_CLOSED} SELECT CAST(gr AS BIGINT) AS gr, CAST(gc AS BIGINT) AS gc FROM shrunk")
def blocked_close(spark, d):
    """A mosaic's mask closed over blocks that send each other their borders."""
    mask = blocks.closed(blocks.thresholded(_mosaic(spark, d, 24), 100), 1, 24)
    return blocks.to_pixels(mask, size=24).filter("v = 1").select("gr", "gc")


#: The same on one wide tile: pixels are numbered further apart, and places around them are listed before they are joined.
_WIDE_SIEVE = (
    _sieve(4, "1", "closed", 1).replace("r * 64 + c", "r * 2147483648 + c").replace(" AS (SELECT", " AS MATERIALIZED (SELECT")
    .replace(f"FROM m a, {NEAR} JOIN", f"FROM (SELECT m.*, r + dr AS nr, c + dc AS nc FROM m, {NEAR}) a JOIN").replace("b.r = a.r + dr AND b.c = a.c + dc", "b.r = a.nr AND b.c = a.nc")
)


@query("merged_mask_cleanup", f"""WITH {_CLOSED},
closed AS MATERIALIZED (SELECT 0 AS tile_id, y AS r, x AS c, CASE WHEN s.gr IS NULL THEN 0 ELSE 1 END AS v FROM area, range(rows + 1) a(y), range(cols + 1) b(x) LEFT JOIN shrunk s ON s.gr = y AND s.gc = x),
{_WIDE_SIEVE} SELECT CAST(r AS BIGINT) AS gr, CAST(c AS BIGINT) AS gc, CAST(mask AS INT) AS mask FROM done""")
def merged_mask_cleanup(spark, d):
    """The merged mask closed, and its small objects given to what is around them, across blocks."""
    mask = blocks.cleanup(blocks.thresholded(_mosaic(spark, d, 24), 100), close_pixels=1, remove_objects=4, size=24)
    return blocks.to_pixels(mask, size=24).select("gr", "gc", F.col("v").cast("int").alias("mask"))


@query("blocked_resize", f"SELECT CAST(tile_id AS VARCHAR) AS scene, CAST(r AS BIGINT) AS gr, CAST(c AS BIGINT) AS gc, v FROM ({ORACLE_BILINEAR})")
def blocked_resize(spark, d):
    """Each tile, as a mosaic of blocks, resized by blocks of the result."""
    rows = table(spark, d, "raster").groupBy(F.col("tile_id").cast("string").alias("scene")).agg(
        (F.max("r") + 1).alias("height"), (F.max("c") + 1).alias("width"), F.transform(F.sort_array(F.collect_list(F.struct("r", "c", "v"))), lambda x: x["v"].cast("float")).alias("values")
    )
    made = blocks.mosaic_mean(rows.select("scene", F.lit(0).alias("row_off"), F.lit(0).alias("col_off"), "height", "width", "values"), 30)
    sizes = rows.select("scene", F.lit(80).cast("long").alias("to_rows"), F.lit(96).cast("long").alias("to_cols"))
    return blocks.to_pixels(blocks.resized(made, sizes, 30, out="<f8"), "<f8", 30).select("scene", "gr", "gc", F.round("v", 6).alias("v"))


@query("polygon_area_of_regions", f"{_components(50, False)} SELECT tile_id, label, CAST(count(*) AS DOUBLE) AS area FROM lab GROUP BY tile_id, label")
def polygon_area_of_regions(spark, d):
    return shapes.polygonize(components4(spark, d)).select("tile_id", "label", geometry.polygon_area(F.col("rings")).alias("area"))


@query("rectangle_shapes")
def rectangle_shapes(spark, d):
    polygons = shapes.rectangularized(shapes.polygonize(components4(spark, d)), 0.9)
    return polygons.select("tile_id", "label", F.round(geometry.polygon_area(F.col("rings")), 6).alias("area"), F.size(F.get("rings", F.lit(0))).alias("points"))


@query("regular_shapes")
def regular_shapes(spark, d):
    polygons = shapes.regularized(shapes.polygonize(components4(spark, d)), tolerance=0.5)
    return polygons.select("tile_id", "label", F.round(geometry.polygon_area(F.col("rings")), 6).alias("area"), F.size(F.get("rings", F.lit(0))).alias("points"))


def _ring():
    return geometry.box_ring(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))


@query("polygon_area_shoelace", "SELECT label_id, CAST((x1 - x0) * (y1 - y0) AS DOUBLE) AS area, (x0 + x1) / 2.0 AS mid_x, (y0 + y1) / 2.0 AS mid_y FROM boxes")
def polygon_area_shoelace(spark, d):
    rings = table(spark, d, "boxes").withColumn("ring", _ring())
    middle = geometry.centroid(F.col("ring"))
    return rings.select("label_id", geometry.polygon_area(F.array("ring")).alias("area"), F.round(middle["x"], 6).alias("mid_x"), F.round(middle["y"], 6).alias("mid_y"))


@query("axis_snapped_boxes", "SELECT label_id, 5 AS points, CAST((x1 - x0) * (y1 - y0) AS DOUBLE) AS area FROM boxes")
def axis_snapped_boxes(spark, d):
    x0, y0, x1, y1 = (F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1"))
    tilted = F.array(geometry.point(x0, y0), geometry.point(x1, y0 + 0.5), geometry.point(x1 + 0.5, y1), geometry.point(x0, y1 + 0.5), geometry.point(x0, y0))
    rings = table(spark, d, "boxes").withColumn("ring", geometry.axis_snapped(tilted, 12.0))
    straight = F.transform("ring", lambda p: geometry.point(F.floor(p["x"]), F.floor(p["y"])))
    return rings.select("label_id", F.size("ring").alias("points"), F.abs(geometry.signed_area(straight)).alias("area"))


def _label_windows(spark):
    scene = spark.createDataFrame([(1, SCENE, SCENE, 64, 16)], "scene_id int, width int, height int, tile_size int, overlap int")
    return windows.window_grid(scene)


LABEL_GRID = f"scene1 AS (SELECT 1 AS scene_id, {SCENE} AS width, {SCENE} AS height, 64 AS tile_size, 16 AS overlap), " + GRID.replace("FROM scenes)", "FROM scene1)").replace("\n", " ")


@query("tile_label_join", f"WITH {LABEL_GRID} SELECT tile_idx, label_id FROM grid JOIN boxes ON x0 <= col_off + win_width AND x1 >= col_off AND y0 <= row_off + win_height AND y1 >= row_off")
def tile_label_join(spark, d):
    return labels.tile_label_join(_label_windows(spark), table(spark, d, "boxes"), 64).select("tile_idx", "label_id")


BURNT = f"burnt AS (SELECT DISTINCT CAST(y AS INT) AS r, CAST(x AS INT) AS c FROM boxes, range({SCENE}) b(y), range({SCENE}) a(x) WHERE y + 0.5 >= y0 AND y + 0.5 < y1 AND x + 0.5 >= x0 AND x + 0.5 < x1)"


@query("rasterize_labels", f"WITH {BURNT} SELECT r, count(*) AS pixels, CAST(sum(c) AS BIGINT) AS places FROM burnt GROUP BY r")
def rasterize_labels(spark, d):
    burnt = labels.rasterize(table(spark, d, "boxes"), SCENE, SCENE)
    return burnt.groupBy("r").agg(F.count(F.lit(1)).alias("pixels"), F.sum("c").alias("places"))


COUNTED = f"counted AS (SELECT tile_idx, win_width, win_height, (SELECT count(*) FROM burnt WHERE r >= row_off AND r < row_off + win_height AND c >= col_off AND c < col_off + win_width) AS positive_pixels FROM grid)"


@query("positive_pixels", f"WITH {BURNT}, {LABEL_GRID}, {COUNTED} SELECT tile_idx, positive_pixels FROM counted")
def positive_pixels(spark, d):
    return labels.positive_pixels(_label_windows(spark), labels.rasterize(table(spark, d, "boxes"), SCENE, SCENE)).select("tile_idx", "positive_pixels")


@query("chip_summary", f"WITH {BURNT}, {LABEL_GRID}, {COUNTED} SELECT count(*) AS windows, count(*) FILTER (WHERE win_width < 64 OR win_height < 64) AS partial, count(*) FILTER (WHERE positive_pixels >= 900) AS chips, count(*) FILTER (WHERE positive_pixels >= 900) AS positive, CAST(0 AS BIGINT) AS empty FROM counted")
def chip_summary(spark, d):
    counted = labels.positive_pixels(_label_windows(spark), labels.rasterize(table(spark, d, "boxes"), SCENE, SCENE))
    return labels.chip_summary(counted, 64, 900, False)


@query("dissolve_by_tile_class", "SELECT source_tile, class_name, count(*) AS parts, CAST(sum(area_m2) AS BIGINT) AS area_m2 FROM detections WHERE class_name IS NOT NULL GROUP BY ALL")
def dissolve_by_tile_class(spark, d):
    return features.dissolve(table(spark, d, "detections"), ["source_tile", "class_name"], keep_null_keys=False)


@query("dissolve_by_class", "SELECT class_name, count(*) AS parts, CAST(sum(area_m2) AS BIGINT) AS area_m2 FROM detections GROUP BY ALL")
def dissolve_by_class(spark, d):
    return features.dissolve(table(spark, d, "detections"), ["class_name"], keep_null_keys=True)


@query("min_area_filter", "SELECT source_tile, class_name, area_m2, l_orderkey, l_linenumber FROM detections WHERE area_m2 >= 15")
def min_area_filter(spark, d):
    return features.at_least(table(spark, d, "detections"), 15)


@query("max_pixel_size_filter", "SELECT scene_id, width, height FROM scenes WHERE scene_id % 5 <> 0 AND greatest(900.0 / width, 700.0 / height) <= 1.2")
def max_pixel_size_filter(spark, d):
    scenes = table(spark, d, "scenes").withColumns({
        "crs_epsg": F.when(F.col("scene_id") % 5 != 0, 26913), "x0": F.lit(100.0), "x1": F.lit(1000.0), "y0": F.lit(800.0), "y1": F.lit(100.0)})
    return features.fine_enough(scenes, 1.2).select("scene_id", "width", "height")


@query("job_upsert", "SELECT job_id, arg_max(workflow_id, seq) FILTER (workflow_id IS NOT NULL) AS workflow_id, CAST(sum(feature_count) AS BIGINT) AS feature_count, arg_max(loaded_at, seq) AS loaded_at, max(seq) AS seq, 'loaded' AS status FROM loads GROUP BY job_id")
def job_upsert(spark, d):
    loads = table(spark, d, "loads").drop("status")
    return features.upsert_jobs(loads.filter("seq % 2 = 0"), loads.filter("seq % 2 = 1"))


@query("append_schema_evolution", "SELECT source_tile, class_name, area_m2, NULL::VARCHAR AS job_id, NULL::VARCHAR AS workflow_id FROM detections UNION ALL SELECT NULL, NULL, NULL, job_id, workflow_id FROM loads")
def append_schema_evolution(spark, d):
    stored = table(spark, d, "detections").select("source_tile", "class_name", "area_m2")
    return features.append_evolving(stored, table(spark, d, "loads").select("job_id", "workflow_id"))


@query("duplicate_ids", "SELECT job_id, count(*) AS n FROM loads GROUP BY job_id HAVING count(*) > 1")
def duplicate_ids(spark, d):
    return features.duplicate_ids(table(spark, d, "loads"), "job_id")


@query("unknown_refs", "SELECT DISTINCT workflow_id FROM loads WHERE workflow_id IS NOT NULL AND workflow_id NOT IN ('wf-1', 'wf-3')")
def unknown_refs(spark, d):
    known = spark.createDataFrame([("wf-1",), ("wf-3",)], "workflow_id string")
    return features.unknown_refs(table(spark, d, "loads"), "workflow_id", known)


@query("run_status_rollup", "SELECT job_id, CASE WHEN bool_or(status = 'failed') THEN 'failed' ELSE 'succeeded' END AS status, count(*) AS runs FROM loads GROUP BY job_id")
def run_status_rollup(spark, d):
    return features.run_status(table(spark, d, "loads"))


CONFUSION = "c AS (SELECT tile_id, count(*) FILTER (WHERE pred = 1 AND truth = 1) AS tp, count(*) FILTER (WHERE pred = 1 AND truth <> 1) AS fp, count(*) FILTER (WHERE pred <> 1 AND truth = 1) AS fn FROM evaluation GROUP BY tile_id), s AS (SELECT *, tp / greatest(tp + fp, 1.0) AS precision, tp / greatest(tp + fn, 1.0) AS recall, tp / greatest(tp + fp + fn, 1.0) AS iou, 2 * tp / greatest(2 * tp + fp + fn, 1.0) AS dice FROM c)"


@query("segmentation_metrics", f"WITH {CONFUSION} SELECT * FROM s")
def segmentation_metrics(spark, d):
    return metrics.confusion(table(spark, d, "evaluation"), "tile_id")


@query("best_epoch", f"WITH {CONFUSION} SELECT arg_min(tile_id, (-iou, tile_id)) AS epoch, max(iou) AS iou FROM s")
def best_epoch(spark, d):
    return metrics.best_epoch(segmentation_metrics(spark, d).select(F.col("tile_id").alias("epoch"), "iou"))


@query("dice_iou_coef", "SELECT tile_id, round((i + 1e-6) / (t - i + 1e-6), 6) AS iou_coef, round((2 * i + 1e-6) / (t + 1e-6), 6) AS dice_coef, round(1 - (2 * i + 1e-6) / (t + 1e-6), 6) AS dice_loss FROM (SELECT tile_id, CAST(sum(pred * truth) AS DOUBLE) AS i, CAST(sum(pred) + sum(truth) AS DOUBLE) AS t FROM evaluation GROUP BY tile_id)")
def dice_iou_coef(spark, d):
    out = metrics.soft_scores(table(spark, d, "evaluation"), "tile_id")
    return out.select("tile_id", *[F.round(c, 6).alias(c) for c in ("iou_coef", "dice_coef", "dice_loss")])


@query("combined_loss", """SELECT tile_id, round(avg(-ln(CASE WHEN truth = 1 THEN p ELSE 1 - p END)) + 0.5 * (1 - (2 * sum(prob * truth) + 1) / (sum(prob) + sum(truth) + 1)), 6) AS loss
FROM (SELECT tile_id, truth, prob, greatest(least(prob, 1 - 1e-7), 1e-7) AS p FROM (SELECT tile_id, truth, CAST(r * 64 + c AS DOUBLE) / 4096 AS prob FROM evaluation)) GROUP BY tile_id""")
def combined_loss(spark, d):
    rows = table(spark, d, "evaluation").withColumn("prob", (F.col("r") * 64 + F.col("c")).cast("double") / 4096)
    return metrics.combined_loss(rows, "tile_id", dice_weight=0.5).withColumn("loss", F.round("loss", 6))


@query("footprint_bounds", "SELECT scene_id, -105.0 - width / 1000.0 AS west, CAST(36.0 AS DOUBLE) AS south, CAST(-105.0 AS DOUBLE) AS east, 36.0 + height / 1000.0 AS north FROM scenes")
def footprint_bounds(spark, d):
    w, h = F.col("width") / 1000.0, F.col("height") / 1000.0
    corners = table(spark, d, "scenes").select("scene_id", F.array(F.lit(-105.0), -105.0 - w).alias("xs"), F.array(F.lit(36.0) + h, F.lit(36.0)).alias("ys"))
    return features.footprints(corners)


@query("web_mercator_bounds", """SELECT item_id, round(radians(west) * 6378137, 3) AS x0, round(ln(tan(pi() / 4 + radians(south) / 2)) * 6378137, 3) AS y0, round(radians(east) * 6378137, 3) AS x1, round(ln(tan(pi() / 4 + radians(north) / 2)) * 6378137, 3) AS y1 FROM items WHERE south > -80 AND north < 80""")
def web_mercator_bounds(spark, d):
    b = crs.reproject_bounds(*(F.col(c).cast("double") for c in ("west", "south", "east", "north")), 4326, 3857)
    rows = table(spark, d, "items").filter("south > -80 AND north < 80").withColumn("b", b)
    return rows.select("item_id", *[F.round(f"b.{k}", 3).alias(n) for k, n in (("west", "x0"), ("south", "y0"), ("east", "x1"), ("north", "y1"))])


@query("utm_round_trip", "SELECT DISTINCT west, south, true AS same FROM items WHERE west BETWEEN -110 AND -100 AND south BETWEEN 0 AND 70")
def utm_round_trip(spark, d):
    rows = table(spark, d, "items").filter("west BETWEEN -110 AND -100 AND south BETWEEN 0 AND 70").select("west", "south").distinct()
    x, y = crs.to_utm13(F.col("west").cast("double"), F.col("south").cast("double"))
    moved = rows.withColumns({"x": x, "y": y})
    lon, lat = crs.from_utm13(F.col("x"), F.col("y"))
    return moved.select("west", "south", ((F.abs(lon - F.col("west")) < 1e-7) & (F.abs(lat - F.col("south")) < 1e-7)).alias("same"))


@query("stac_top1", """SELECT item_id, rank, distance FROM (SELECT item_id, CASE WHEN west <= 30.5 AND east >= 30.5 AND south <= 20.5 AND north >= 20.5 THEN 0 ELSE 1 END AS rank,
pow((west + east) / 2 - 30.5, 2) + pow((south + north) / 2 - 20.5, 2) AS distance FROM items) ORDER BY rank, distance, item_id LIMIT 1""")
def stac_top1(spark, d):
    return features.best_item(table(spark, d, "items"), 25.0, 15.0, 36.0, 26.0).select("item_id", "rank", "distance")


@query("bbox_checked", "SELECT item_id, greatest(CAST(west * 2 AS DOUBLE), -180) AS west, greatest(CAST(south * 2 AS DOUBLE), -90) AS south, least(CAST(east * 2 AS DOUBLE), 180) AS east, least(CAST(north * 2 AS DOUBLE), 90) AS north FROM items")
def bbox_checked(spark, d):
    b = geometry.checked_bbox(*[F.col(c) * 2 for c in ("west", "south", "east", "north")])
    return table(spark, d, "items").select("item_id", b.alias("b")).select("item_id", "b.*")


@query("json_extract", "SELECT item_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM items")
def json_extract(spark, d):
    return table(spark, d, "items").select("item_id", F.from_json("props", "k long")["k"].alias("k"))


@query("osm_building_area", "SELECT label_id AS osm_id, 'labels' AS extent_source, 1 AS parts, CAST((x1 - x0) * (y1 - y0) AS DOUBLE) AS area FROM boxes")
def osm_building_area(spark, d):
    at = lambda x, y: f"'{{\"lon\":', {x}, ',\"lat\":', {y}, '}}'"
    way = f"concat('{{\"type\":\"way\",\"id\":', label_id, ',\"tags\":{{\"building\":\"yes\"}},\"geometry\":[', {at('x0', 'y0')}, ',', {at('x1', 'y0')}, ',', {at('x1', 'y1')}, ',', {at('x0', 'y1')}, ']}}') AS element"
    rows = osm.buildings(table(spark, d, "boxes").selectExpr(way), "Label-Package")
    return rows.select("osm_id", "extent_source", F.size("geometry").alias("parts"), F.aggregate("geometry", F.lit(0.0), lambda s, p: s + geometry.polygon_area(p)).alias("area"))


@query("mask_names", "SELECT DISTINCT source_tile, source_tile || '_road_mask.tif' AS name FROM detections")
def mask_names(spark, d):
    rows = table(spark, d, "detections").select("source_tile").distinct()
    return rows.select("source_tile", features.mask_name(F.concat("source_tile", F.lit(".tif")), F.lit("road")).alias("name"))


DEMO = """demo AS (SELECT (abs(i // 256 - 128) <= 4 OR abs(i % 256 - 92) <= 4 OR abs(i // 256 - (0.55 * (i % 256) + 40)) <= 4) AS road FROM range(65536) t(i))"""


@query("demo_scene", f"WITH {DEMO} SELECT count(*) AS pixels, count(*) FILTER (WHERE road) AS road_pixels, CAST(count(*) FILTER (WHERE road) AS DOUBLE) AS area, CAST(1 AS BIGINT) AS regions FROM demo")
def demo_scene(spark, d):
    """The whole path on a made scene: bands, scaling, normalising, mean model, sigmoid gate, threshold, region, polygon."""
    rows = spark.range(65536).select((F.col("id") / 256).cast("int").alias("r"), (F.col("id") % 256).cast("int").alias("c"))
    road = (F.abs(F.col("r") - 128) <= 4) | (F.abs(F.col("c") - 92) <= 4) | (F.abs(F.col("r") - (0.55 * F.col("c") + 40)) <= 4)
    bands = F.explode(F.array(*[
        F.struct(F.lit(k).alias("band"), F.when(road, on).otherwise(off).alias("v"), F.lit(m).alias("mean"), F.lit(s).alias("std"))
        for k, (on, off, m, s) in enumerate([(230, 76, 0.485, 0.229), (230, 110, 0.456, 0.224), (225, 86, 0.406, 0.225)])
    ]))
    image = rows.withColumn("tile_id", F.lit(0)).withColumn("b", bands).select("tile_id", "r", "c", "b.*")
    x = image.withColumn("x", (pixels.imagery_scale(F.col("v")) - F.col("mean")) / F.col("std"))
    score = x.groupBy("tile_id", "r", "c").agg(F.avg("x").alias("score"))
    mask = score.withColumn("p", pixels.probability_gate(F.col("score"))).withColumn("mask", pixels.thresholded(F.col("p"), 0.5))
    region = shapes.polygonize(morphology.tile_components(mask, 4)).select(geometry.polygon_area(F.col("rings")).alias("area"))
    rows = mask.groupBy().agg(F.count(F.lit(1)).alias("pixels"), F.sum("mask").alias("road_pixels")).withColumn("k", F.lit(0))
    traced = region.groupBy().agg(F.sum("area").alias("area"), F.count(F.lit(1)).alias("regions")).withColumn("k", F.lit(0))
    return rows.join(traced, "k").drop("k")
