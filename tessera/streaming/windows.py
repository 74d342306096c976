"""Event-time windows with late data, for batch and stream alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_event_time(events: DataFrame, column: str = "ts", late: str | None = None) -> DataFrame:
    """A zoned event time from a zoneless one (UTC sessions), with a watermark on streams."""
    timed = events.withColumn(column, F.col(column).cast("timestamp"))
    return timed.withWatermark(column, late) if late else timed


def tumbling(events: DataFrame, size: str, keys: list[str], column: str = "ts") -> DataFrame:
    grouped = events.groupBy(F.window(column, size).alias("w"), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return grouped.select(F.col("w.start").alias("start"), *keys, "n", "total")


def sliding(events: DataFrame, size: str, step: str, keys: list[str], column: str = "ts") -> DataFrame:
    grouped = events.groupBy(F.window(column, size, step).alias("w"), *keys).agg(F.count("*").alias("n"))
    return grouped.select(F.col("w.start").alias("start"), *keys, "n")


def sessions(events: DataFrame, gap: str, key: str, column: str = "ts") -> DataFrame:
    grouped = events.groupBy(F.session_window(column, gap).alias("w"), key).agg(F.count("*").alias("n"))
    return grouped.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
