"""Distributed union-find over a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialize

#: Links that one task may resolve by itself (under 100 MB of a Python worker, by estimate).
TASK_LINKS = 1 << 18


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``u, v`` of each node of a partition's links: ``v`` is the smallest node it is connected with there, itself too.

    Nodes are let go beyond twice TASK_LINKS, more than that many links can have, so a partition of any size takes bounded
    memory and is cut into several forests.
    """
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    def stars() -> pa.RecordBatch:
        nodes = list(parent)
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], names=["u", "v"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > 2 * TASK_LINKS:
            yield stars()
            parent.clear()
    yield stars()


def star_round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step: each node sends its neighbours to the smallest of them."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low"))
    large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    large = large.where("u <> v").distinct()
    least = large.groupBy("u").agg(F.min("v").alias("low"))
    joined = large.join(least, "u")
    small = joined.select(F.col("v").alias("u"), F.col("low").alias("v")).unionAll(joined.select("u", F.col("low").alias("v")))
    return small.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` to ``(id, root)``: the smallest id of the connected component of each id that has a link.

    Each task first joins what its own links connect. If what remains is no
    more than TASK_LINKS, one task more joins it; else large-star and
    small-star rounds go on until each component is a star. Neighbour minima
    are partial aggregates, so the hub of a large component is no hot task;
    each round is a written table, so a lost executor costs one round at most.
    Self-links and repeated links have no effect; no links give no rows.
    """
    local = links.where("a <> b").select("a", "b").mapInArrow(forest, "u long, v long")
    edges = materialize(local.where("u <> v"), "edges")
    number = edges.count()
    if number <= TASK_LINKS:
        joined = edges.coalesce(1).mapInArrow(forest, "u long, v long")
        return materialize(joined.select(F.col("u").alias("id"), F.col("v").alias("root")), "roots")
    checksum = lambda: edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    edges = materialize(edges.distinct(), "edges")
    before = checksum()
    while True:
        edges = materialize(star_round(edges), "edges")
        now = checksum()
        if now == before:
            break
        before = now
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("id"), "root")
    return roots.unionAll(edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
