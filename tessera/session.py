"""A SparkSession with the settings the library expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "tessera", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true"} | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
