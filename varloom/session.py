"""A session with the settings that the plans count on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "varloom", **conf: str) -> SparkSession:
    """Adaptive execution with skew joins, UTC, ANSI arithmetic; further settings by keyword with dots as double underscores."""
    base = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true"}
    builder = SparkSession.builder.appName(name)
    for k, v in (base | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
