"""Map elements as JSON rows, to building polygons."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.functions.geometry import closed, signed_area
from rasterloom.operators.features import extent_source

ELEMENT = (
    "type string, id long, tags map<string,string>, geometry array<struct<lat:double,lon:double>>, "
    "members array<struct<role:string,geometry:array<struct<lat:double,lon:double>>>>"
)


def fetched(spark: SparkSession, fetch: Callable[[], list[str]]) -> DataFrame:
    """elements(element) of a caller's fetch function, which asks a service for one area and returns JSON texts."""
    return spark.createDataFrame([(x,) for x in fetch()], "element string")


def _ring(points: Column) -> Column:
    """The closed ring of a line of at least four points, null for fewer or for one without an area."""
    ring = closed(F.transform(points, lambda p: F.struct(p["lon"].alias("x"), p["lat"].alias("y"))))
    return F.when(F.size(points) >= 4, F.when(F.abs(signed_area(ring)) > 0, ring))


def buildings(elements: DataFrame, extent: str) -> DataFrame:
    """osm_type, osm_id, building, name, extent_source and geometry, a multipolygon, of elements(element).

    A way is one polygon. A relation has one for each member in the outer or in no role; holes of inner members are
    not cut. Elements without a polygon are left out; unknown extents are an error.
    """
    e = elements.select(F.from_json("element", ELEMENT).alias("e")).select("e.*")
    outer = F.filter("members", lambda m: F.coalesce(m["role"], F.lit("-")).isin("", "outer"))
    lines = F.when(F.col("type") == "way", F.array("geometry")).when(F.col("type") == "relation", F.transform(outer, lambda m: m["geometry"]))
    polygons = F.transform(F.filter(F.transform(lines, _ring), lambda r: r.isNotNull()), lambda r: F.array(r))
    kind = extent_source(F.lit(extent))
    checked = F.coalesce(kind, F.raise_error(F.lit("extent must be imagery or labels")).cast("string"))
    return e.withColumn("geometry", polygons).filter(F.size("geometry") > 0).select(
        F.col("type").alias("osm_type"), F.coalesce("id", F.lit(0)).cast("long").alias("osm_id"),
        F.coalesce(F.try_element_at("tags", F.lit("building")), F.lit("")).alias("building"),
        F.coalesce(F.try_element_at("tags", F.lit("name")), F.lit("")).alias("name"), checked.alias("extent_source"), "geometry",
    )
