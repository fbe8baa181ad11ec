"""A session with the settings that these operators are meant to run under."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "folioscope", master: str | None = None, **conf: str) -> SparkSession:
    """Adaptive execution with skewed joins split, times in UTC; any other setting as given."""
    b = SparkSession.builder.appName(name).config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true").config("spark.sql.session.timeZone", "UTC")
    b = b.master(master) if master else b
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()
