"""A session with the settings the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "vireo", **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **more}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
