"""Spark sessions with the settings that results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "driftwell", master: str | None = None, **conf) -> SparkSession:
    """UTC, ANSI and adaptive execution; sizes stay the cluster's own."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    fixed = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true"}
    for key, value in (fixed | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
