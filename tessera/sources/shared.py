"""Written intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; where that is unset, a new one of our own in local mode, an error on a cluster."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not known:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        known = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", known)
    return known.rstrip("/")


def delete_at_end(spark: SparkSession, path: str) -> None:
    """The folder goes when the driver's JVM ends: a result may be read, and read again, until then."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back: later uses neither recompute it nor depend on a lost executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tessera/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    delete_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)
