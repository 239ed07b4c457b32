"""Sinks: tiles, masks and chips as partitioned Parquet, features as GeoJSON lines or GeoPackages, loads with a job log."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.operators.features import append_evolving, identifier, upsert_jobs
from rasterloom.sources.tiff import encode
from rasterloom.sources.vectors import gpkg_bytes, polygons_wkb

JOBS = "job_id string, workflow_id string, feature_count long, loaded_at timestamp, seq long"
MODES = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}


def write_tiles(tiles: DataFrame, folder: str, key: str = "scene_id") -> None:
    """Tiles, masks or probabilities, one folder for each scene; scenes that are written again are replaced, others stay."""
    tiles.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(folder)


def tiff_files(tiles: DataFrame, kind: str = "uint8") -> DataFrame:
    """(name, content) of a GeoTIFF for each tile(tile_id, height, width, bands, transform, crs_epsg, tags)."""
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for t in batch.itertuples(index=False):
                image = np.stack([np.asarray(b) for b in t.bands]).reshape(len(t.bands), t.height, t.width).astype(kind)
                place = tuple(t.transform[k] for k in "abcdef")
                rows.append((f"{t.tile_id}.tif", encode(image, place, None if pd.isna(t.crs_epsg) else int(t.crs_epsg), dict(t.tags) if t.tags is not None else None)))
            yield pd.DataFrame(rows, columns=["name", "content"])

    return tiles.select("tile_id", "height", "width", "bands", "transform", "crs_epsg", "tags").mapInPandas(of, "name string, content binary")


def feature_json(properties: list[str], geometry: str = "geometry") -> Column:
    """A GeoJSON feature's text from columns and a multipolygon."""
    places = F.transform(geometry, lambda p: F.transform(p, lambda r: F.transform(r, lambda q: F.array(q["x"], q["y"]))))
    shape = F.struct(F.lit("MultiPolygon").alias("type"), places.alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), shape.alias("geometry")), {"ignoreNullFields": "false"})


def write_geojson_lines(features: DataFrame, folder: str, geometry: str = "geometry") -> None:
    """A GeoJSON feature on each line; an empty table leaves a folder with no lines."""
    features.select(feature_json([c for c in features.columns if c != geometry], geometry).alias("value")).write.mode("overwrite").text(folder)


def wkb(geometry: Column) -> Column:
    """A multipolygon column as well-known binary; Arrow arrays, as parts of unequal lengths have no pandas form."""
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([None if x is None else polygons_wkb(x) for x in batch.to_pylist()], pa.binary())

    return F.arrow_udf(of, "binary")(geometry)


def geopackages(features: DataFrame, key: str, epsg: int = 4326, layer: str = "features", geometry: str = "geometry", most: int = 100_000) -> DataFrame:
    """(key, part, content): GeoPackages of the features of each value of key, such as a scene.

    A key of over ``most`` features is dealt, by a hash of its rows, to as many packages of about that size as it
    takes, numbered from 0, so a task never holds a whole hot key.
    """
    others = [c for c in features.columns if c not in (key, geometry)]
    kind = dict(features.dtypes)[key]

    def of(part: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for r in part.to_dict("records"):
            plain = {c: (None if pd.isna(r[c]) else r[c].item() if hasattr(r[c], "item") else r[c]) for c in others}
            rows.append((plain, r["_wkb"]))
        return pd.DataFrame({key: [part[key].iloc[0]], "part": [part["_part"].iloc[0]], "content": [gpkg_bytes(rows, epsg, layer)]})

    shapes = features.select(key, *others, wkb(F.col(geometry)).alias("_wkb"))
    sizes = features.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / most).alias("_parts")).filter("_parts > 1").withColumnRenamed(key, "_of")
    dealt = shapes.join(sizes, F.col(key).eqNullSafe(F.col("_of")), "left").withColumn(
        "_part", F.pmod(F.xxhash64("_wkb", *others), F.coalesce("_parts", F.lit(1))).cast("int")
    )
    return dealt.drop("_of", "_parts").groupBy(key, "_part").applyInPandas(of, f"{key} {kind}, part int, content binary")


def write_manifest(chips: DataFrame, folder: str) -> None:
    """The chips' CSV manifest with a header: split, image, mask, positive_pixels and bounds."""
    bounds = F.format_string("%.8f,%.8f,%.8f,%.8f", "west", "south", "east", "north")
    chips.select("split", "image", "mask", "positive_pixels", bounds.alias("bounds")).write.mode("overwrite").option("header", True).csv(folder)


def empty_features(spark: SparkSession) -> DataFrame:
    from rasterloom.operators.features import FEATURE_SCHEMA

    return spark.createDataFrame([], FEATURE_SCHEMA)


def load_features(
    features: DataFrame, folder: str, mode: str = "append", job_id: str | None = None, metadata: dict[str, str] | None = None,
    loaded_at: str = "1970-01-01 00:00:00", seq: int = 0,
) -> int:
    """Writes features to ``folder``/features and the load to its job log; returns the number of features.

    An empty table leaves the features as they are, under replace too, and logs a count of 0. Metadata become columns.
    Appending may bring new columns: readers see those of all files.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")
    spark = features.sparkSession
    rows = features.withColumnRenamed("geometry", "geom")
    for key, value in (metadata or {}).items():
        rows = rows.withColumn(identifier(key, "metadata column"), F.lit(value))
    if job_id:
        rows = rows.withColumn("job_id", F.lit(job_id))
    if job_id or metadata:
        rows = rows.withColumn("loaded_at", F.lit(loaded_at).cast("timestamp"))
    count = rows.count()
    if count:
        rows.write.mode(MODES[mode]).parquet(f"{folder}/features")
    if job_id:
        entry = [(job_id, (metadata or {}).get("workflow_id"), count, seq)]
        log = spark.createDataFrame(entry, "job_id string, workflow_id string, feature_count long, seq long")
        log.withColumn("loaded_at", F.lit(loaded_at).cast("timestamp")).select("job_id", "workflow_id", "feature_count", "loaded_at", "seq").write.mode("append").parquet(f"{folder}/job_log")
    return count


def stored_features(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(f"{folder}/features")


def jobs(spark: SparkSession, folder: str) -> DataFrame:
    """The job table: the log of loads, each (job_id, seq) once, rolled up."""
    log = spark.read.schema(JOBS).parquet(f"{folder}/job_log").dropDuplicates(["job_id", "seq"])
    return upsert_jobs(spark.createDataFrame([], JOBS), log)


def as_json(metrics: DataFrame) -> str:
    """A one-row table of metrics as JSON text."""
    return json.dumps(json.loads(metrics.toJSON().first()), sort_keys=True)


__all__ = ["append_evolving", "as_json", "empty_features", "feature_json", "geopackages", "jobs", "load_features", "stored_features", "tiff_files", "write_geojson_lines", "wkb", "write_manifest", "write_tiles"]
