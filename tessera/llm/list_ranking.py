"""Distributed ranking of a linked list, and sums along it.

A list is shortened level by level. Items are dealt to tasks, each task joins
those whose successor it holds into runs, and the runs are the items of the
next, shorter list, which one task holds in the end. Positions then come down
again: that of a run, and of each item in it. Items are first dealt by a key
along which neighbours tend to lie together; where that shortens the list by
less than a quarter, they are dealt by coin flips instead: an item that shows
heads goes to where its successor is, if that shows tails, which joins a
quarter of them whatever the list looks like.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .storage import materialize

#: Items one task joins at a time (some 100 MB of arrays), and to how many a task the list is dealt.
AT_ONCE, A_TASK = 1 << 20, 1 << 18
#: Items that are few enough for one task to join what is left.
LAST = 1 << 14
#: Runs, two longs each, up to which their positions are sent to every task.
BROADCAST_ROWS = 1_000_000

_LINKS = "id long, head long, offset long, next long, length long, near long, depth long"


def join_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each item with its run's first item and its offset there; that first item also with the run's successor and length."""
    held: list[pa.RecordBatch] = []

    def runs() -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        ids, length = (t.column(c).to_numpy() for c in ("id", "length"))
        ends = t.column("next").is_null().to_numpy()
        after = t.column("next").fill_null(0).to_numpy()
        n, order = len(ids), np.argsort(ids, kind="stable")
        by_id = ids[order]
        at = np.minimum(np.searchsorted(by_id, after), n - 1)
        here = ~ends & (by_id[at] == after)
        last = np.flatnonzero(~here)
        before = np.arange(n)
        before[order[at[here]]] = np.flatnonzero(here)
        first = before == np.arange(n)
        offset = np.where(first, 0, length[before])
        while not first[before].all():  # each step doubles the reach
            offset = offset + offset[before]
            before = before[before]
        end = np.zeros(n, dtype=np.int64)
        end[before[last]] = last
        total = offset[end] + length[end]
        return pa.RecordBatch.from_arrays([
            pa.array(ids), pa.array(ids[before]), pa.array(offset), pa.array(after[end], mask=~first | ends[end]), pa.array(total, mask=~first),
            pa.array(t.column("near").to_numpy(), mask=~first), pa.array(t.column("depth").to_numpy(), mask=~first)], names=["id", "head", "offset", "next", "length", "near", "depth"])

    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= AT_ONCE:
            yield runs()
            held, size = [], 0
    if size:
        yield runs()


def coin(item: str) -> F.Column:
    return F.xxhash64(F.lit(7), F.col(item)) % 2 == 0


def list_positions(items: DataFrame) -> DataFrame:
    """``id, pos`` from 0 along the list of ``id, next, near, depth``; the last item's ``next`` is null.

    ``near`` and ``depth`` say how items are dealt; they don't change positions.
    ``id`` is unique and the list is one. No items give none.
    """
    spark = items.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    levels: list[DataFrame] = []
    runs: list[int] = []
    items = items.select("id", "next", F.lit(1).cast("long").alias("length"), "near", "depth")
    n, flip = items.count(), False
    tasks = max(tasks, -(-n // A_TASK))
    while True:
        if flip:
            mate = F.when(coin("id") & F.col("next").isNotNull() & ~coin("next"), F.col("next")).otherwise(F.col("id"))
            dealt = items.repartition(tasks, mate)
        else:
            dealt = items.coalesce(1) if levels and n <= LAST else items.repartitionByRange(tasks, "near", "depth")
        joined = materialize(dealt.mapInArrow(join_runs, _LINKS), "runs")
        levels.append(joined.select("id", "head", "offset"))
        items = joined.where("id = head").select("id", "next", "length", "near", "depth")
        before, n = n, items.count()
        runs.append(n)
        if n <= 1:
            break
        flip, tasks = not flip and n > LAST and 4 * n > 3 * before, max(1, -(-n // LAST))
    places = levels[-1].select("id", F.col("offset").alias("pos"))
    for level, n in zip(reversed(levels[:-1]), reversed(runs[:-1]), strict=True):
        heads = places.select(F.col("id").alias("head"), "pos")
        places = level.join(F.broadcast(heads) if n <= BROADCAST_ROWS else heads, "head").select("id", (F.col("pos") + F.col("offset")).alias("pos"))
    return places


def running_sums(rows: DataFrame, at: str, values: list[str], width: int = 1024, levels: int = 3) -> DataFrame:
    """Replaces ``values`` by their sums over the rows up to each row's place ``at``, which is unique.

    Sums within blocks of ``width`` places, and of the blocks before, found in
    the same way; the last level, a row for each ``width`` ** 3 places, is one window.
    """
    if levels == 0:
        return rows.withColumns({v: F.sum(v).over(W.orderBy(at).rowsBetween(W.unboundedPreceding, 0)) for v in values})
    block = f"__block{levels}"
    place = F.floor(F.col(at) / width).alias(block)
    inner = W.partitionBy(block).orderBy(at).rowsBetween(W.unboundedPreceding, 0)
    blocks = rows.groupBy(place).agg(*(F.sum(v).alias(v) for v in values), *(F.sum(v).alias(f"__own_{v}") for v in values))
    before = running_sums(blocks, block, values, width, levels - 1).select(block, *((F.col(v) - F.col(f"__own_{v}")).alias(f"__{v}") for v in values))
    own = rows.select("*", place).withColumns({v: F.sum(v).over(inner) for v in values})
    return own.join(before, block).withColumns({v: F.col(v) + F.col(f"__{v}") for v in values}).select(*rows.columns)
