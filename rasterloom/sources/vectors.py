"""Vector files: GeoJSON by Spark's own JSON reader, GeoPackage and ZIP members in tasks."""

from __future__ import annotations

import io
import json
import sqlite3
import struct
import zipfile
from collections.abc import Iterator
from pathlib import PurePosixPath

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

POINTS = "array<struct<x:double,y:double>>"
GEOMETRY = f"array<array<{POINTS}>>"
FEATURE = f"properties string, crs_epsg int, geometry {GEOMETRY}"
SUFFIXES = (".gpkg", ".geojson", ".json")


def polygons_of(geometry: Column) -> Column:
    """A GeoJSON geometry's text as a multipolygon; other kinds than polygons give null."""
    kind = F.get_json_object(geometry, "$.type")
    one = F.from_json(F.get_json_object(geometry, "$.coordinates"), "array<array<array<double>>>")
    many = F.from_json(F.get_json_object(geometry, "$.coordinates"), "array<array<array<array<double>>>>")
    parts = F.when(kind == "Polygon", F.array(one)).when(kind == "MultiPolygon", many)
    return F.transform(parts, lambda p: F.transform(p, lambda r: F.transform(r, lambda q: F.struct(q[0].alias("x"), q[1].alias("y")))))


def geojson_features(texts: DataFrame, column: str = "value") -> DataFrame:
    """properties and geometry of every feature of GeoJSON texts: a geometry, a feature or a collection. WGS 84."""
    text = F.col(column)
    kind = F.get_json_object(text, "$.type")
    listed = F.from_json(F.get_json_object(text, "$.features"), "array<string>")
    feature = F.explode(F.when(kind == "FeatureCollection", listed).otherwise(F.array(text)))
    each = texts.select(feature.alias("f"))
    bare = F.get_json_object("f", "$.type") != "Feature"
    shape = F.when(bare, F.col("f")).otherwise(F.get_json_object("f", "$.geometry"))
    return each.select(
        F.get_json_object("f", "$.properties").alias("properties"), F.lit(4326).alias("crs_epsg"), polygons_of(shape).alias("geometry")
    ).filter(F.col("geometry").isNotNull())


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    return geojson_features(spark.read.text(path, wholetext=True))


def wkb_polygons(data: bytes) -> list | None:
    """The multipolygon of well-known binary; None for other kinds."""
    order = "<" if data[0] == 1 else ">"
    kind, at = struct.unpack(f"{order}I", data[1:5])[0], 5
    def polygon(at: int) -> tuple[list, int]:
        n, at = struct.unpack(f"{order}I", data[at : at + 4])[0], at + 4
        rings = []
        for _ in range(n):
            m, at = struct.unpack(f"{order}I", data[at : at + 4])[0], at + 4
            xy = struct.unpack(f"{order}{2 * m}d", data[at : at + 16 * m])
            rings.append([{"x": x, "y": y} for x, y in zip(xy[::2], xy[1::2], strict=True)])
            at += 16 * m
        return rings, at

    if kind == 3:
        return [polygon(at)[0]]
    if kind != 6:
        return None
    n, at, out = struct.unpack(f"{order}I", data[at : at + 4])[0], at + 4, []
    for _ in range(n):
        rings, at = polygon(at + 5)
        out.append(rings)
    return out


def polygons_wkb(parts: list) -> bytes:
    """Well-known binary, little-endian, of a multipolygon."""
    out = struct.pack("<BII", 1, 6, len(parts))
    for rings in parts:
        out += struct.pack("<BII", 1, 3, len(rings))
        for ring in rings:
            out += struct.pack("<I", len(ring)) + b"".join(struct.pack("<2d", p["x"], p["y"]) for p in ring)
    return out


def _gpkg_rows(content: bytes, layer: str | None) -> list[tuple]:
    db = sqlite3.connect(":memory:")
    db.deserialize(content)
    tables = db.execute("SELECT table_name, column_name, srs_id FROM gpkg_geometry_columns ORDER BY table_name").fetchall()
    chosen = next((t for t in tables if layer in (None, t[0])), None)
    if chosen is None:
        raise ValueError(f"no layer {layer!r}")
    table, column, srs = chosen
    quoted = table.replace('"', '""')
    found = db.execute(f'SELECT * FROM "{quoted}"')
    names, rows = [x[0] for x in found.description], []
    for row in found:
        values = dict(zip(names, row, strict=True))
        blob = values.pop(column)
        if blob:
            extra = {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}[(blob[3] >> 1) & 7]
            shape = wkb_polygons(blob[8 + extra :])
            if shape is not None:
                rows.append((json.dumps({k: v for k, v in values.items() if not isinstance(v, bytes)}), srs, shape))
    return rows


def _geojson_rows(content: bytes) -> list[tuple]:
    data, rows = json.loads(content), []
    for f in data.get("features", [data]) if isinstance(data, dict) else []:
        shape = f.get("geometry") if f.get("type") == "Feature" else f
        if shape and shape.get("type") in ("Polygon", "MultiPolygon"):
            parts = [shape["coordinates"]] if shape["type"] == "Polygon" else shape["coordinates"]
            rows.append((json.dumps(f.get("properties") or {}), 4326, [[[{"x": p[0], "y": p[1]} for p in r] for r in part] for part in parts]))
    return rows


def vector_features(files: DataFrame, layer: str | None = None) -> DataFrame:
    """Features of GeoPackages, GeoJSON or ZIP archives in files(path, content); of a ZIP the first vector member counts."""
    def rows_of(name: str, content: bytes) -> list[tuple]:
        suffix = PurePosixPath(name).suffix.lower()
        if suffix == ".gpkg":
            return _gpkg_rows(content, layer)
        if suffix in SUFFIXES:
            return _geojson_rows(content)
        if suffix == ".zip":
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                for member in archive.namelist():
                    if PurePosixPath(member).suffix.lower() in SUFFIXES:
                        return rows_of(member, archive.read(member))
        raise ValueError(f"no vector layer in {name}")

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for p, content in zip(batch["path"], batch["content"], strict=True):
                yield pd.DataFrame(rows_of(p, bytes(content)), columns=["properties", "crs_epsg", "geometry"])

    return files.select("path", "content").mapInPandas(of, FEATURE)


def read_vectors(spark: SparkSession, path: str, layer: str | None = None) -> DataFrame:
    """Features of GeoPackage, GeoJSON or ZIP files, each read in a task."""
    return vector_features(spark.read.format("binaryFile").load(path), layer)


def label_source(candidates: list[DataFrame | None], crs_epsg: int | None = None) -> DataFrame:
    """The first of the candidate feature tables that has a row, such as a stored label file and then seed detections.

    None stands for a source that isn't there. If no candidate has a row, the first table without its rows, under
    ``crs_epsg`` or else 4326; with no table at all that is an error. Each test reads one row.
    """
    there = [c for c in candidates if c is not None]
    if not there:
        raise ValueError("no label source")
    for c in there:
        if c.take(1):
            return c
    return there[0].limit(0).withColumn("crs_epsg", F.lit(crs_epsg or 4326))


def gpkg_bytes(rows: list[tuple[dict, list | bytes | None]], epsg: int, layer: str) -> bytes:
    """A GeoPackage of (properties, shape) rows: a shape is a multipolygon's parts or their well-known binary."""
    db = sqlite3.connect(":memory:")
    db.executescript(
        """PRAGMA application_id = 1196444487; PRAGMA user_version = 10300;
        CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER PRIMARY KEY, organization TEXT NOT NULL, organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT);
        CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT UNIQUE, description TEXT DEFAULT '', last_change DATETIME DEFAULT '1970-01-01T00:00:00.000Z', min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE, srs_id INTEGER);
        CREATE TABLE gpkg_geometry_columns (table_name TEXT NOT NULL, column_name TEXT NOT NULL, geometry_type_name TEXT NOT NULL, srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL);"""
    )
    db.execute("INSERT INTO gpkg_spatial_ref_sys VALUES (?, ?, 'EPSG', ?, 'undefined', NULL)", (f"EPSG:{epsg}", epsg, epsg))
    db.execute("INSERT INTO gpkg_contents (table_name, data_type, identifier, srs_id) VALUES (?, 'features', ?, ?)", (layer, layer, epsg))
    db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'MULTIPOLYGON', ?, 0, 0)", (layer, epsg))
    names = sorted({k for properties, _ in rows for k in properties})
    quote = lambda x: '"' + x.replace('"', '""') + '"'
    db.execute(f"CREATE TABLE {quote(layer)} ({', '.join(['fid INTEGER PRIMARY KEY AUTOINCREMENT', 'geom MULTIPOLYGON', *map(quote, names)])})")
    for properties, shape in rows:
        body = polygons_wkb(shape) if isinstance(shape, list) else shape
        blob = None if body is None else struct.pack("<2sBBi", b"GP", 0, 1, epsg) + body
        db.execute(f"INSERT INTO {quote(layer)} ({', '.join(['geom', *map(quote, names)])}) VALUES ({', '.join('?' * (len(names) + 1))})", [blob, *[properties.get(n) for n in names]])
    db.commit()
    return db.serialize()

