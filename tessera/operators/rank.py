"""Ranks, bands, limits and neighbourhoods over a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.sources.shared import materialize


def global_rank(df: DataFrame, *order: Column, name: str = "rn", keys: Sequence[str] = ()) -> DataFrame:
    """``row_number`` over the whole table, or within ``keys``, where one task can't hold what is numbered together.

    Rows are dealt once by range of keys and order and written with the place
    of each in its range, so that sizes and places come from one dealing. A
    range's rows are then moved up by what the table, or the group that began
    before, holds in the ranges before. ``order`` must end in a unique key;
    null keys are a group.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = [*(F.asc(k) for k in keys), *order]
    dealt = materialize(df.repartitionByRange(n, *ranges).sortWithinPartitions(*ranges).withColumn("__at", F.monotonically_increasing_id()), "rank")
    dealt = dealt.withColumn("__part", F.shiftright("__at", 33))
    sizes = dealt.groupBy("__part", *keys).agg(F.count("*").alias("__n"))
    before = W.partitionBy(*keys).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.withColumn("__start", F.sum("__n").over(before)).where("__start > 0")  # a range continues one group at most
    starts = F.broadcast(starts.select(F.col("__part").alias("__p"), *(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), "__start"))
    met = F.col("__part") == F.col("__p")
    for i, k in enumerate(keys):
        met = met & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    inner = F.row_number().over(W.partitionBy("__part", *keys).orderBy("__at")) if keys else F.col("__at").bitwiseAND((1 << 33) - 1) + 1
    out = dealt.withColumn("__rn", inner).join(starts, met, "left")
    return out.select(*df.columns, (F.col("__rn") + F.coalesce("__start", F.lit(0))).alias(name))


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_per_group(df: DataFrame, keys: list[str], k: int, *order: Column, name: str = "rn") -> DataFrame:
    return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= k)


def best_per_group(df: DataFrame, keys: list[str], value: Column, by: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.max_by(value, by).alias("best"))


def band_stats(ranked: DataFrame, score: str, bands: list[tuple[str, int, int]], rank: str = "rn") -> DataFrame:
    """count, min, max, mean and median of the score in half-open rank bands; a band whose end is past the last rank is dropped.

    As ranks follow the score, a band's median is that of its one or two middle ranks.
    """
    spark = ranked.sparkSession
    limits = F.broadcast(spark.createDataFrame(bands, "band string, start long, end long"))
    n = F.broadcast(ranked.agg(F.count("*").alias("n")))
    inside = (F.col(rank) > F.col("start")) & (F.col(rank) <= F.col("end"))
    size = F.col("end") - F.col("start")
    middle = F.col(rank).isin(F.col("start") + F.floor((size + 1) / 2), F.col("start") + F.floor(size / 2) + 1)
    return ranked.join(limits, inside).crossJoin(n).where(F.col("end") <= F.col("n")).groupBy("band").agg(F.count("*").alias("count"), F.min(score).alias("min_score"), F.max(score).alias("max_score"), F.avg(score).alias("mean_score"), F.avg(F.when(middle, F.col(score))).alias("median_score"))


def cutoff_gap(ranked: DataFrame, score: str, cutoff: int, rank: str = "rn") -> DataFrame:
    """Statistics either side of a rank cutoff and how clearly it separates them."""
    chosen = F.col(rank) <= cutoff
    sides = ranked.agg(
        F.count_if(chosen).alias("n_selected"), F.count_if(~chosen).alias("n_rejected"),
        F.min(F.when(chosen, F.col(score))).alias("selected_min"), F.avg(F.when(chosen, F.col(score))).alias("selected_mean"),
        F.max(F.when(~chosen, F.col(score))).alias("rejected_max"), F.avg(F.when(~chosen, F.col(score))).alias("rejected_mean"))
    gap = F.col("selected_min") - F.col("rejected_max")
    return sides.withColumn("gap", gap).withColumn("separation", F.when(F.col("gap") > 0.001, "clear").when(F.col("gap") > 0, "small").otherwise("none"))


def stride_sample(ranked: DataFrame, every: int, k: int, rank: str = "rn") -> DataFrame:
    """The first ``k`` of each ``every`` ranks, labelled by the ranks of their group."""
    first = F.col(rank) - (F.col(rank) - 1) % every
    label = F.when(first == 1, F.lit(f"Top 1-{k}")).otherwise(F.concat(F.lit("Rank "), first.cast("string")))
    return ranked.where((F.col(rank) - 1) % every < k).withColumn("label", label)


def neighbourhood(ranked: DataFrame, cutoff: int, width: int = 5, rank: str = "rn") -> DataFrame:
    status = F.when(F.col(rank) <= cutoff, "SELECTED").otherwise("REJECTED")
    return ranked.where(F.col(rank).between(cutoff - width, cutoff + width)).withColumn("status", status)


def topk_of_stages(stages: list[DataFrame], keys: list[str], k: int, *order: Column, name: str = "rn") -> DataFrame:
    """The ``k`` best rows of each key over all stages' rows together; ``stage`` is the place of a row's stage in the list."""
    rows = None
    for i, stage in enumerate(stages):
        own = stage.withColumn("stage", F.lit(i))
        rows = own if rows is None else rows.unionByName(own)
    return top_per_group(rows, keys, k, *order, F.asc("stage"), name=name)


def max_detections(df: DataFrame, image: list[str], score: str, inserted: str, limit: int) -> DataFrame:
    """Each image's detections by falling score, at most ``limit``; equal scores keep the order of insertion, as a stable sort would."""
    return top_per_group(df, image, limit, F.desc(score), F.asc(inserted))


def wrapped_shares(df: DataFrame, workers: int, *order: Column) -> DataFrame:
    """``index, worker`` for each row: equal shares dealt in turn, the first rows again where the last round isn't full.

    Duplicates stay in, as in training every worker takes as many steps; fewer
    rows than workers stand several times. No rows give no rows.
    """
    n = F.broadcast(df.agg(F.count("*").alias("__n")))
    ranked = global_rank(df, *order, name="__r").crossJoin(n)
    last = F.ceil(F.col("__n") / workers) * workers - 1
    return ranked.withColumn("index", F.explode(F.sequence(F.col("__r") - 1, last, F.col("__n")))).withColumn("worker", F.col("index") % workers).drop("__r", "__n")


def balanced(items: DataFrame, workers: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """Each item goes to the worker of its group with the least load so far, the first of equal ones: ``keys, worker`` beside the item.

    ``workers(keys, worker, load)``. As an item adds one to a load, a worker
    offers the places load, load + 1, ..., and the k-th item takes the k-th
    smallest (place, worker): two ranks and a join in place of a loop.
    """
    numbered = items.withColumn("__k", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    counts = items.groupBy(*keys).agg(F.count("*").alias("__n"))
    places = workers.join(counts, keys).withColumn("__at", F.explode(F.sequence(F.col("load"), F.col("load") + F.col("__n") - 1)))
    taken = places.withColumn("__k", F.row_number().over(W.partitionBy(*keys).orderBy("__at", "worker"))).where(F.col("__k") <= F.col("__n"))
    return numbered.join(taken.select(*keys, "__k", "worker"), [*keys, "__k"]).drop("__k")
