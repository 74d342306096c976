"""Every registered query of the library outside ``llm``, with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.plans import annotations, augment, enrichment, geometry, masks, media, metrics, records, scoring, sessions, tracking  # noqa: F401  (registers)
from tessera.plans.common import ORACLES, QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
