"""Feature tables: regions of masks, dissolving, area filters, schema evolution, job loads and checks."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.functions.crs import reproject_bounds
from rasterloom.functions.geometry import checked_bbox
from rasterloom.operators import overlay

FEATURE_SCHEMA = "source_tile string, class_name string, confidence double, geometry array<array<array<struct<x:double,y:double>>>>"


def region_facts(labelled: DataFrame, pixel_area: float = 1.0) -> DataFrame:
    """Pixels, area and pixel box of each component of labelled(tile_id, r, c, label)."""
    return labelled.groupBy("tile_id", "label").agg(
        F.count(F.lit(1)).alias("pixels"), (F.count(F.lit(1)) * pixel_area).alias("area"),
        F.min("r").alias("r0"), F.min("c").alias("c0"), F.max("r").alias("r1"), F.max("c").alias("c1"),
    )


def component_sizes(labelled: DataFrame) -> DataFrame:
    """How many components have each size."""
    return labelled.groupBy("tile_id", "label").agg(F.count(F.lit(1)).alias("pixels")).groupBy("pixels").agg(F.count(F.lit(1)).alias("components"))


def dissolve(features: DataFrame, keys: list[str], keep_null_keys: bool) -> DataFrame:
    """Features of equal keys as one: their number and total area. Rows with a null key stay only with keep_null_keys."""
    rows = features if keep_null_keys else features.dropna(subset=keys)
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("parts"), F.sum("area_m2").alias("area_m2"))


def dissolve_parts(features: DataFrame, geometry: str = "geometry", cell: float = 512.0, grid: float = overlay.GRID) -> DataFrame:
    """One multipolygon for each tile and class, the union of its polygons, with the first confidence that isn't null.

    Rows without a tile or class go; a tile and class stays without any area, and polygons without a point stay as they
    are. ``cell`` and ``grid`` are those of ``overlay.united``.
    """
    keys = ["source_tile", "class_name"]
    rows = features.dropna(subset=keys)
    parts = overlay.united(rows.select(*keys, F.explode(geometry).alias("rings")), keys, cell=cell, grid=grid)
    whole = parts.groupBy(*keys).agg(F.collect_list("rings").alias("_whole"))
    pointless = F.flatten(F.collect_list(F.filter(geometry, lambda polygon: F.size(F.flatten(polygon)) == 0)))
    facts = rows.groupBy(*keys).agg(F.first("confidence", ignorenulls=True).alias("confidence"), pointless.alias("_pointless"))
    both = F.concat(F.coalesce("_whole", F.filter("_pointless", lambda _: F.lit(False))), "_pointless")
    return facts.join(whole, keys, "left").select(*keys, "confidence", both.alias(geometry))


def at_least(features: DataFrame, area: float) -> DataFrame:
    """Features of at least an area; 0 leaves all."""
    return features.filter(F.col("area_m2") >= area) if area > 0 else features


def fine_enough(scenes: DataFrame, most: float) -> DataFrame:
    """Scenes whose larger pixel side, in metres, is at most a limit; without a CRS none is, and 0 leaves all."""
    if most <= 0:
        return scenes
    side = F.greatest(F.abs(F.col("x1") - F.col("x0")) / F.greatest("width", F.lit(1)), F.abs(F.col("y1") - F.col("y0")) / F.greatest("height", F.lit(1)))
    return scenes.filter(F.col("crs_epsg").isNotNull() & (side <= most))


def identifier(name: str, what: str = "column") -> str:
    """name, if it is a plain SQL identifier."""
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
        raise ValueError(f"invalid {what} name: {name!r}")
    return name


def append_evolving(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Both tables' rows under all columns of either; loaded_at becomes a timestamp, empty text null."""
    def aligned(df: DataFrame) -> DataFrame:
        if "loaded_at" in df.columns and dict(df.dtypes)["loaded_at"] == "string":
            return df.withColumn("loaded_at", F.expr("try_cast(nullif(loaded_at, '') AS timestamp)"))
        return df

    return aligned(stored).unionByName(aligned(new), allowMissingColumns=True)


def upsert_jobs(jobs: DataFrame, loads: DataFrame) -> DataFrame:
    """jobs(job_id, workflow_id, feature_count, loaded_at, seq) after loads of the same columns.

    One combined aggregate for any number of loads: counts add up, the latest workflow that isn't null wins, so does
    the latest loaded_at. Loads without a job id do nothing. Re-applying a batch is the caller's to prevent (the
    streaming sink keys by batch).
    """
    every = jobs.unionByName(loads).filter(F.col("job_id").isNotNull())
    return every.groupBy("job_id").agg(
        F.max_by("workflow_id", F.when(F.col("workflow_id").isNotNull(), F.col("seq"))).alias("workflow_id"),
        F.sum("feature_count").alias("feature_count"), F.max_by("loaded_at", "seq").alias("loaded_at"), F.max("seq").alias("seq"),
    ).withColumn("status", F.lit("loaded"))


def duplicate_ids(table: DataFrame, key: str) -> DataFrame:
    return table.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def unknown_refs(table: DataFrame, key: str, known: DataFrame) -> DataFrame:
    """Values of key that known, with a column of the same name, doesn't have; null refers to nothing."""
    return table.select(key).filter(F.col(key).isNotNull()).distinct().join(known.select(key), key, "left_anti")


def run_status(runs: DataFrame) -> DataFrame:
    """One status for each job: failed if any of its runs failed."""
    return runs.groupBy("job_id").agg(
        F.when(F.bool_or(F.col("status") == "failed"), "failed").otherwise("succeeded").alias("status"), F.count(F.lit(1)).alias("runs")
    )


def best_item(items: DataFrame, west: float, south: float, east: float, north: float) -> DataFrame:
    """The item whose box holds the centre of the area, or else is nearest to it; without a box last, ties to item_id."""
    x, y = (west + east) / 2, (south + north) / 2
    inside = (F.col("west") <= x) & (F.col("east") >= x) & (F.col("south") <= y) & (F.col("north") >= y)
    far = F.pow((F.col("west") + F.col("east")) / 2 - x, F.lit(2)) + F.pow((F.col("south") + F.col("north")) / 2 - y, F.lit(2))
    whole = F.col("west").isNotNull() & F.col("south").isNotNull() & F.col("east").isNotNull() & F.col("north").isNotNull()
    scored = items.withColumns({
        "rank": F.when(~whole, 2).when(inside, 0).otherwise(1), "distance": F.when(whole, far).otherwise(F.lit(float("inf")))
    })
    return scored.orderBy("rank", "distance", "item_id").limit(1)


def extent_source(name: Column) -> Column:
    """The kind of extent that a name, in any spelling, stands for; null for none."""
    plain = F.replace(F.lower(F.trim(name)), F.lit("-"), F.lit("_"))
    return F.when(plain.isin("imagery", "cog", "raster"), "imagery").when(plain.isin("labels", "label", "label_package", "package"), "labels")


def mask_name(name: Column, class_name: Column) -> Column:
    """The mask's file name for a tile's: stem, class and _mask."""
    return F.concat(F.regexp_replace(name, r"\.[^.]*$", ""), F.lit("_"), class_name, F.lit("_mask.tif"))


def footprints(scenes: DataFrame) -> DataFrame:
    """The box around each scene's corner points, from scenes(scene_id, xs, ys)."""
    return scenes.select(
        "scene_id", F.array_min("xs").alias("west"), F.array_min("ys").alias("south"), F.array_max("xs").alias("east"), F.array_max("ys").alias("north")
    )


def scene_footprints(scenes: DataFrame) -> DataFrame:
    """Catalog rows of scanned scenes: names, source tags (empty where missing), sizes and the WGS 84 box around the outline.

    Scenes without a known CRS are an error.
    """
    t = F.col("transform")
    west, north = t["c"], t["f"]
    east, south = west + t["a"] * F.col("width"), north + t["e"] * F.col("height")
    box = F.lit(None)
    for code in (4326, 3857, 26913):
        box = F.when(F.col("crs_epsg") == code, reproject_bounds(west, south, east, north, code, 4326)).otherwise(box)
    unknown = F.raise_error(F.concat(F.lit("no known CRS: "), F.col("path")))
    tag = lambda k: F.coalesce(F.try_element_at("tags", F.lit(k)), F.lit("")).alias(k)
    return scenes.filter(F.col("crs_epsg").isin(4326, 3857, 26913) | unknown.cast("boolean")).select(
        F.col("scene_id").alias("cog_id"), F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("path").alias("file_path"),
        tag("source_collection"), tag("source_item"), tag("source_href"), F.concat(F.lit("EPSG:"), F.col("crs_epsg")).alias("native_crs"),
        "width", "height", "band_count", t["a"].alias("pixel_size_x"), F.abs(t["e"]).alias("pixel_size_y"), box.alias("bounds"),
    )


def label_extent(features: DataFrame, geometry: str = "geometry") -> DataFrame:
    """One row: the box around all multipolygons, clamped to the globe; null without any."""
    points = features.select(F.explode(F.flatten(F.flatten(geometry))).alias("p"))
    around = points.groupBy().agg(F.min("p.x").alias("w"), F.min("p.y").alias("s"), F.max("p.x").alias("e"), F.max("p.y").alias("n"))
    return around.select(checked_bbox(F.col("w"), F.col("s"), F.col("e"), F.col("n")).alias("bounds"))


def time_slug(moment: Column) -> Column:
    """A UTC time as 20240131T235959Z."""
    return F.date_format(moment, "yyyyMMdd'T'HHmmss'Z'")
