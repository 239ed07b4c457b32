"""Rasters, scenes and feature tables derived from the synthetic tables, for queries that SQL can check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RASTER_SPARK = """
SELECT CAST(vec_id DIV 64 AS INT) tile_id, CAST(vec_id % 64 AS INT) r, c, CAST(floor(CAST(e AS DOUBLE) * 1000) AS INT) v
FROM embeddings LATERAL VIEW posexplode(embedding) t AS c, e
"""
RASTER_SQL = """
SELECT CAST(vec_id // 64 AS INT) tile_id, CAST(vec_id % 64 AS INT) r, CAST(i AS INT) c,
       CAST(floor(CAST(embedding[i+1] AS DOUBLE) * 1000) AS INT) v
FROM embeddings, range(64) t(i)
"""
#: Valid on both engines.
SHARED = {
    "scenes": "SELECT p_partkey AS scene_id, CAST(64 + (p_partkey*37) % 4000 AS INT) AS width, CAST(64 + p_size*41 AS INT) AS height, 256 AS tile_size, 64 AS overlap FROM part",
    "boxes": "SELECT s_suppkey AS label_id, CAST((s_suppkey*37)%448 AS INT) AS x0, CAST((s_suppkey*53)%448 AS INT) AS y0, CAST((s_suppkey*37)%448 + 8 + s_suppkey%40 AS INT) AS x1, CAST((s_suppkey*53)%448 + 8 + (s_suppkey*7)%40 AS INT) AS y1 FROM supplier",
    "detections": "SELECT concat('tile_', CAST(l_suppkey % 50 AS STRING)) AS source_tile, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_returnflag END AS class_name, CAST(l_quantity AS INT) AS area_m2, l_orderkey, l_linenumber FROM lineitem",
    "loads": "SELECT concat('job-', CAST(o_custkey % 50 AS STRING)) AS job_id, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE concat('wf-', CAST(o_orderkey % 7 AS STRING)) END AS workflow_id, CAST(o_orderkey % 11 AS BIGINT) AS feature_count, o_orderkey AS seq, o_orderdate AS loaded_at, CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'succeeded' END AS status FROM orders",
    "items": "SELECT event_id AS item_id, CAST(event_id % 350 - 180 AS INT) AS west, CAST(event_id % 170 - 90 AS INT) AS south, CAST(event_id % 350 - 180 + 10 AS INT) AS east, CAST(event_id % 170 - 90 + 10 AS INT) AS north, props FROM events",
    "logits": "SELECT l_orderkey AS tile_id, l_linenumber, CAST((25 - l_quantity)/10 AS DOUBLE) AS z0, CAST((l_quantity - 20)/10 AS DOUBLE) AS z1 FROM lineitem",
}
EVAL = "SELECT tile_id, r, c, CAST(v >= 50 AS INT) AS pred, CAST(((v+600)%3 = 0 OR v >= 80) AS INT) AS truth FROM raster"
_TABLES = {"scenes": "part", "boxes": "supplier", "detections": "lineitem", "loads": "orders", "items": "events", "logits": "lineitem"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture as a DataFrame."""
    if name in ("raster", "evaluation"):
        vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
        raster = spark.sql(RASTER_SPARK.replace("FROM embeddings", "FROM {embeddings}"), embeddings=vectors)
        return raster if name == "raster" else spark.sql(EVAL.replace("FROM raster", "FROM {raster}"), raster=raster)
    source = _TABLES[name]
    rows = spark.read.parquet(f"{sf_dir}/{source}.parquet")
    return spark.sql(SHARED[name].replace(f"FROM {source}", f"FROM {{{source}}}"), **{source: rows})


def with_fixtures(sql: str) -> str:
    """sql, for DuckDB, with the fixtures that it names as common tables before it."""
    made = {"raster": RASTER_SQL, **SHARED, "evaluation": EVAL}
    used = [n for n in made if f" {n}" in sql or f"{n}." in sql]
    if "evaluation" in used and "raster" not in used:
        used.insert(0, "raster")
    if not used:
        return sql.strip()
    ctes = ", ".join(f"{n} AS ({made[n].strip()})" for n in used)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {ctes}, {body[len('WITH RECURSIVE'):]}"
    return f"WITH {ctes}, {body[4:]}" if body.upper().startswith("WITH") else f"WITH {ctes} {body}"
