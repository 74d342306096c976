"""Score statistics, histograms and threshold counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.rank import global_rank


def valid_scores(df: DataFrame, score: str) -> DataFrame:
    """Drops the failure mark (below 0), nulls and NaN."""
    return df.where((F.col(score) >= 0) & ~F.isnan(score))


def quantiles(df: DataFrame, score: str, shares: dict[str, float]) -> DataFrame:
    """One row with a column a share, by linear interpolation between the two ranks around it; nulls don't count, no rows give nulls.

    Ranks come from a dealing by range: no task holds all values.
    """
    ranked = global_rank(df.select(F.col(score).alias("__v")).where("__v is not null"), F.asc("__v"), name="__r")
    n = F.broadcast(ranked.agg(F.count("*").alias("__n")))
    at = {name: (F.col("__n") - 1) * share for name, share in shares.items()}
    low = {name: F.floor(a) for name, a in at.items()}
    picked = [F.max(F.when(F.col("__r") == low[name] + 1 + k, F.col("__v"))).alias(f"__{name}{k}") for name in shares for k in (0, 1)]
    ends = ranked.crossJoin(n).agg(F.max("__n").alias("__n"), *picked)
    between = lambda name: F.col(f"__{name}0") + F.when(at[name] > low[name], (F.col(f"__{name}1") - F.col(f"__{name}0")) * (at[name] - low[name])).otherwise(0.0)
    return ends.select(*(between(name).alias(name) for name in shares))


def describe(df: DataFrame, score: str) -> DataFrame:
    """count, mean, population deviation, min, max, median and quartiles (linear)."""
    moments = df.agg(F.count(score).alias("count"), F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"), F.min(score).alias("min"), F.max(score).alias("max"))
    return moments.crossJoin(F.broadcast(quantiles(df, score, {"median": 0.5, "q25": 0.25, "q75": 0.75})))


def describe_by(df: DataFrame, key: str, score: str) -> DataFrame:
    """Per key, with the sample deviation."""
    return df.groupBy(key).agg(F.avg(score).alias("mean"), F.stddev_samp(score).alias("std"), F.min(score).alias("min"), F.max(score).alias("max"))


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Counts in equal bins from least to greatest value; the last bin holds the greatest."""
    ends = F.broadcast(df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")))
    raw = F.floor((F.col(value) - F.col("lo")) * bins / (F.col("hi") - F.col("lo")))
    at = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1)))
    return df.crossJoin(ends).select(at.cast("long").alias("bin")).groupBy("bin").agg(F.count("*").alias("count"))


def counts_above(df: DataFrame, score: str, thresholds: list[float], split: Column) -> DataFrame:
    """Rows at or above each threshold, per split and in total."""
    marks = F.broadcast(df.sparkSession.createDataFrame([(t,) for t in thresholds], "threshold double"))
    met = df.select(F.col(score).alias("s"), split.alias("split")).crossJoin(marks)
    counted = F.count_if(F.col("s") >= F.col("threshold")).alias("count")
    return met.groupingSets([["threshold", "split"], ["threshold"]], "threshold", "split").agg(counted).withColumn("split", F.coalesce("split", F.lit("Total")))
