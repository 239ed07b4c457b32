"""From masks to features: the steps between polygons of masks and the feature table, in one plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.functions.crs import reproject_ring
from rasterloom.functions.geometry import polygon_area
from rasterloom.operators import features, overlay, pixels, shapes


@dataclass(frozen=True)
class Options:
    """What each step does; 0 or False leaves it out. Lengths and areas are in the unit of the processing system."""

    most_coverage: float = 0.0
    min_area: float = 0.0
    simplify: float = 0.0
    rectangularize: float = 0.0  # the least share of the smallest rectangle that a polygon fills to become it
    dissolve_overlaps: bool = False
    smooth: float = 0.0
    regularize: bool = False
    regularize_simplify: float = 0.0
    angle_tolerance: float = 12.0
    least_ratio: float = 0.7
    most_ratio: float = 1.35
    cell: float = 512.0
    grid: float = overlay.GRID


def mask_polygons(masks: DataFrame, options: Options, transform: tuple[float, ...] = (1.0, 0.0, 0.0, 0.0, 1.0, 0.0)) -> DataFrame:
    """(source_tile, rings) of the regions of dense masks(tile_id, r, c, mask), tiles that are too full left out."""
    from rasterloom.operators.morphology import tile_components

    if options.most_coverage > 0:
        full = pixels.coverage(masks, options.most_coverage).filter("skipped").select("tile_id")
        masks = masks.join(full, "tile_id", "left_anti")
    return shapes.polygonize(tile_components(masks, 4), transform).select(F.col("tile_id").alias("source_tile"), "rings")


def _total(geometry: str):
    return F.aggregate(geometry, F.lit(0.0), lambda s, p: s + polygon_area(p))


def vectorized(polygons: DataFrame, options: Options, source: int | None = None, processing: int | None = None, output: int | None = None) -> DataFrame:
    """Features (source_tile, class_name, confidence, geometry) of polygons(source_tile, class_name, rings).

    In this order: to the processing system, made valid, those under the area out, simplified, made rectangles, united
    (over all tiles with dissolve_overlaps, whose features are then of the tile "merged", one each part; else, unless they
    became rectangles, one feature a tile and class), smoothed, regularised, to the output system. Geometries are
    multipolygons. Features of no area go; an empty table has none. EPSG codes are 4326, 3857 and 26913.
    """
    moved = polygons.withColumn("confidence", F.lit(None).cast("double"))
    if source is not None and processing is not None:
        moved = moved.withColumn("rings", F.transform("rings", lambda r: reproject_ring(r, source, processing)))
    valid = overlay.repaired(overlay.spread(moved), "rings", "geometry", options.grid)
    kept = valid.withColumn("area_", _total("geometry")).filter(F.col("area_") > 0).filter(F.col("area_") >= options.min_area)
    kept = kept.withColumn("of_", F.monotonically_increasing_id())
    parts = kept.select("source_tile", "class_name", "confidence", "of_", F.posexplode("geometry").alias("part_", "rings"))
    parts = shapes.simplified(parts, options.simplify)
    if options.rectangularize > 0:
        parts = shapes.rectangularized(parts, options.rectangularize)
    if options.dissolve_overlaps:
        whole = overlay.united(parts, ["class_name"], cell=options.cell, grid=options.grid)
        out = whole.select(F.lit("merged").alias("source_tile"), "class_name", F.lit(None).cast("double").alias("confidence"), F.array("rings").alias("geometry"))
    elif options.rectangularize > 0:
        # A polygon's parts are one feature again; a polygon is a row, and so are its parts.
        out = parts.groupBy("of_").agg(
            F.first("source_tile").alias("source_tile"), F.first("class_name").alias("class_name"), F.first("confidence").alias("confidence"),
            F.transform(F.sort_array(F.collect_list(F.struct("part_", "rings"))), lambda p: p["rings"]).alias("geometry"),
        ).drop("of_")
    else:
        named = parts.select(F.col("source_tile").cast("string").alias("source_tile"), "class_name", "confidence", F.array("rings").alias("geometry"))
        out = features.dissolve_parts(named, cell=options.cell, grid=options.grid)
    if options.smooth > 0:
        out = overlay.buffered(out.withColumn("flat_", F.flatten("geometry")), [options.smooth, -options.smooth], "flat_", "geometry", options.grid).drop("flat_")
    if options.regularize:
        out = _regular(out, options)
    out = out.withColumn("source_tile", F.col("source_tile").cast("string")).filter(_total("geometry") > 0)
    if processing is not None and output is not None:
        out = out.withColumn("geometry", F.transform("geometry", lambda p: F.transform(p, lambda r: reproject_ring(r, processing, output))))
    return out.select("source_tile", "class_name", "confidence", "geometry")


def _regular(rows: DataFrame, options: Options) -> DataFrame:
    """Each part of each geometry regularised, and what comes out made valid."""
    def of(parts: list) -> list:
        return [shapes.regularize(p, options.regularize_simplify, options.angle_tolerance, options.least_ratio, options.most_ratio) for p in parts]

    drawn = rows.withColumn("geometry", shapes.each_part(of)("geometry"))
    return overlay.repaired(drawn.withColumn("flat_", F.flatten("geometry")), "flat_", "geometry", options.grid).drop("flat_")
