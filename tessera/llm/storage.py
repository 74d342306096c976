"""Reading the given tables, and the texts of any; intermediate tables are written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.shared import materialize, shared_dir

__all__ = ["materialize", "shared_dir", "table", "text_or_empty"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, under fixed names, so that extra columns can't clash; null text is empty."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
