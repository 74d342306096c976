"""Ranks of wide tables, dealt finely and coarsely, against what a rank must be."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators import rank, stats


@pytest.fixture(scope="module")
def wide(spark):
    pad = [F.sha2(F.concat(F.lit(f"{k}|"), F.col("id").cast("string")), 256).alias(f"c{k}") for k in range(4)]
    return spark.range(300_000).select("id", F.floor(F.rand(3) * 1000).alias("score"), (F.col("id") % 100 < 98).cast("int").alias("hot"), *pad)


@pytest.mark.parametrize("parts", [8, 200])
def test_ranks_of_a_wide_table(spark, wide, tmp_path, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rank.global_rank(wide, F.desc("score"), F.asc("id")).write.parquet(f"{tmp_path}/all")
        rank.global_rank(wide, F.desc("score"), F.asc("id"), keys=["hot"]).write.parquet(f"{tmp_path}/keys")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    back = spark.read.parquet(f"{tmp_path}/all")
    assert back.columns == [*wide.columns, "rn"]
    assert back.agg(F.count("*"), F.count_distinct("rn"), F.min("rn"), F.max("rn")).first() == (300_000, 300_000, 1, 300_000)
    follows = F.lag(F.struct((-F.col("score")).alias("s"), "id")).over(W.partitionBy(F.floor(F.col("rn") / 5000)).orderBy("rn"))
    assert back.withColumn("before", follows).where(F.col("before") > F.struct((-F.col("score")).alias("s"), "id")).isEmpty()
    keys = spark.read.parquet(f"{tmp_path}/keys")
    same = F.row_number().over(W.partitionBy("hot").orderBy(F.desc("score"), F.asc("id")))
    assert keys.withColumn("x", same).where("x <> rn").isEmpty()


def test_ranks_of_few_rows(spark):
    none = spark.createDataFrame([], "a long, k string")
    assert rank.global_rank(none, F.asc("a")).count() == 0 and rank.global_rank(none, F.asc("a"), keys=["k"]).count() == 0
    rows = spark.createDataFrame([(3, None), (1, None), (2, "x")], "a long, k string")
    assert {(r["a"], r["rn"]) for r in rank.global_rank(rows, F.asc("a"), keys=["k"]).collect()} == {(1, 1), (3, 2), (2, 1)}


def test_quantiles(spark):
    rows = spark.createDataFrame([(float(x),) for x in (5, 1, 4, 2)] + [(None,)], "v double")
    assert stats.quantiles(rows, "v", {"q": 0.25, "m": 0.5, "top": 1.0}).first() == (1.75, 3.0, 5.0)
    assert stats.quantiles(rows.where("false"), "v", {"m": 0.5}).first() == (None,)
