"""Parent-child tables of annotations: grouping, completion, cascades, keys, shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators.rank import global_rank


def with_children(parents: DataFrame, children: DataFrame, key: str, child: Column, name: str = "children") -> DataFrame:
    """Each parent with the sorted list of its children, empty where it has none."""
    lists = children.groupBy(key).agg(F.sort_array(F.collect_list(child)).alias(name))
    joined = parents.join(lists, key, "left")
    empty = F.array().cast(lists.schema[name].dataType)
    return joined.withColumn(name, F.coalesce(name, empty))


def complete(parents: DataFrame, categories: DataFrame, children: DataFrame, keys: list[str], negatives: bool = True) -> DataFrame:
    """Every parent with every category and the number of children there; only positives without ``negatives``. Categories are a small table."""
    counts = children.groupBy(*keys).agg(F.count("*").alias("n"))
    pairs = parents.crossJoin(F.broadcast(categories))
    out = pairs.join(counts, keys, "left" if negatives else "inner")
    return out.withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def chunked(categories: DataFrame, size: int, order: str) -> DataFrame:
    """Categories in chunks of ``size`` by their order; a small table."""
    return categories.withColumn("chunk", F.floor((F.row_number().over(W.orderBy(order)) - 1) / size))


def cascade(kept: DataFrame, *links: tuple[DataFrame, str, str]) -> list[DataFrame]:
    """Semi-joins down a chain of tables: each (table, its key, the key above) keeps the rows whose parent stayed."""
    out, above = [], kept
    for df, own, parent in links:
        above = df.join(above.select(F.col(parent).alias(own)).distinct(), own, "left_semi")
        out.append(above)
    return out


def missing_keys(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of ``rows`` that ``known`` lacks; empty if the reference holds."""
    return rows.select(*keys).distinct().join(known.select(*keys).distinct(), keys, "left_anti")


def first_shard_wins(rows: DataFrame, shard: str, keys: list[str]) -> DataFrame:
    """Of the shards that hold a key only the first counts; repeats within it stay."""
    firsts = rows.groupBy(*keys).agg(F.min(shard).alias(shard))
    return rows.join(firsts, [*keys, shard], "left_semi")


def surrogate_ids(pairs: DataFrame, *order: Column, name: str = "id") -> DataFrame:
    return global_rank(pairs.distinct(), *order, name=name)


def unique_track_ids(tracks: DataFrame, video: str, track: str) -> DataFrame:
    """A track id that stands in several videos gets a new one in each but the first; others stay."""
    pairs = tracks.select(video, track).distinct()
    firsts = pairs.groupBy(track).agg(F.min(video).alias(video))
    top = F.broadcast(pairs.agg(F.max(track).alias("top")))
    others = pairs.join(firsts, [video, track], "left_anti")
    again = global_rank(others, F.asc(track), F.asc(video), name="k").crossJoin(top).select(video, track, (F.col("top") + F.col("k")).alias("new_id"))
    return firsts.select(video, track, F.col(track).alias("new_id")).unionByName(again)


def reindexed(rows: DataFrame, ids: list[str]) -> DataFrame:
    """Moves every id column by one where the first one's ids begin at 0, as the formats of the field want 1."""
    first = F.broadcast(rows.agg(F.min(ids[0]).alias("__first")))
    moved = rows.crossJoin(first)
    return moved.withColumns({c: F.col(c) + F.when(F.col("__first") == 0, 1).otherwise(0) for c in ids}).drop("__first")


def filled(rows: DataFrame, parents: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Missing values of ``columns`` from the parent row."""
    given = parents.select(key, *(F.col(c).alias(f"__{c}") for c in columns))
    return rows.join(given, key, "left").withColumns({c: F.coalesce(F.col(c), F.col(f"__{c}")) for c in columns}).drop(*(f"__{c}" for c in columns))


def dense_stage(rows: DataFrame, keys: list[str], stage: str, descending: bool = False) -> DataFrame:
    order = F.desc(stage) if descending else F.asc(stage)
    return rows.withColumn("stage_rank", F.dense_rank().over(W.partitionBy(*keys).orderBy(order)) - 1)


def single(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row a key with ``n_rows``; a key of several rows is an error when the result is read, not a silent choice."""
    n = F.count("*")
    message = F.concat(F.lit("several rows of "), F.concat_ws(", ", *(F.col(k).cast("string") for k in keys)))
    rest = [c for c in rows.columns if c not in keys]
    one = rows.groupBy(*keys).agg(F.any_value(F.struct(*rest)).alias("__one"), n.alias("n_rows"))
    checked = one.withColumn("n_rows", F.when(F.col("n_rows") == 1, F.col("n_rows")).otherwise(F.raise_error(message).cast("long")))
    return checked.select(*keys, *(F.col(f"__one.{c}") for c in rest), "n_rows")
