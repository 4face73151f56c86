"""Spark session with the settings that the library's results rest on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "ledgerloom", **conf: str) -> SparkSession:
    """UTC, ANSI semantics and adaptive execution; other settings as given (dots as double underscores)."""
    builder = SparkSession.builder.appName(name)
    defaults = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}
    for k, v in (defaults | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
