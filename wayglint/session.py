"""Session factory."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "wayglint", **conf: str) -> SparkSession:
    """A session with adaptive execution, skew handling and UTC; ``conf`` keys use __ for dots."""
    b = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC")
    b = b.config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()
