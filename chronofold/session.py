"""A session with the settings that the engine is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build(app: str = "chronofold", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, ANSI and adaptive execution; everything else is the cluster's own choice."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**settings, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
