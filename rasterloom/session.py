"""A session with the settings that the engine's plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str = "local[*]", **conf: str) -> SparkSession:
    """A Spark session in UTC with adaptive execution; keyword settings use __ for dots."""
    builder = (
        SparkSession.builder.master(master)
        .appName("rasterloom")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
