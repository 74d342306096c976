"""Memory of Python workers, which Spark reuses from stage to stage."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import SparkSession

#: Rows of an Arrow batch of texts: a few MB for documents of some thousand characters, on either side of the pipe.
TEXT_ROWS = 1000


def texts_in_small_batches(spark: SparkSession) -> None:
    """Lowers the session's rows of an Arrow batch to TEXT_ROWS, if they are more: batches of 10,000 whole texts are held several times over outside the heap."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > TEXT_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXT_ROWS)


def trim() -> None:
    """At the end of a task: what it has freed goes back to the system instead of waiting for the worker's next one."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)
