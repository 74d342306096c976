"""Links between near-duplicates from sketch buckets, with no cap on a bucket's members.

Two cheap rounds compare a bucket's members with its leaders, and only across
components: the bulk of a large group is joined at a cost linear in its size,
and two leaders meet all pairs of a bucket of three. Larger buckets that still
hold several components are then compared whole: their members are dealt into
blocks of bounded size, pairs of blocks into tasks, and a task counts the
elements that sets share by a product of their incidence matrices. Only the
commonest component of a bucket is not compared with itself, as its members
are joined already. A pair that shares several buckets is compared in the
first of them alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .storage import materialize

#: Most buckets sent to all executors (8 bytes each); beyond, members and buckets are both dealt by bucket.
BROADCAST_BUCKETS = 1_000_000
#: Members of a block and elements of their sets together, in the mean; elements that a task reads, in the mean.
BLOCK_ROWS, BLOCK_SIZE, TASK_SIZE = 512, 1 << 19, 1 << 21
#: Columns of an incidence matrix that are multiplied at once.
COLUMNS = 2048


@dataclass(frozen=True)
class Content:
    """What is compared: ``texts(id, text)`` on Spark, their sets of distinct 64-bit elements, and a test of two sets that share enough.

    ``verify`` gives the roots ``ra, rb`` of those rows of ``pairs(a, b, ra,
    rb)`` whose ids are similar. ``sized``: an id's ``n`` is exactly the size of
    its set, and sets of a similarity of at least the floor differ in size by
    that factor at most.
    """

    texts: DataFrame
    sets: Callable[[list[str]], list[np.ndarray]]
    test: Callable[[np.ndarray, np.ndarray], bool] | None
    verify: Callable[[DataFrame], DataFrame]
    sized: bool


def shared_buckets(rows: DataFrame, unique: bool = False) -> DataFrame:
    """``bucket, id, n`` rows of the buckets that hold more than one id, each once; ``unique``: no row stands twice, so a count tells."""
    if unique:
        several = rows.groupBy("bucket").agg(F.count("*").alias("ids")).where("ids > 1")
    else:
        several = rows.groupBy("bucket").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi")
    many = materialize(several.select("bucket"), "buckets")
    if many.count() <= BROADCAST_BUCKETS:
        many = F.broadcast(many)
    live = rows.join(many, "bucket", "left_semi")
    return materialize(live if unique else live.distinct(), "live")


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of ``sets`` share: products of incidence matrices over the elements that two or more hold."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    number, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:]
    column = np.cumsum(often > 1) - 1
    held = often[number] > 1
    owner, number = owner[held], column[number[held]]
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    counts = np.zeros((len(sets), len(sets)), dtype=np.float32)
    width = int(number[-1]) + 1 if len(number) else 0
    for at in range(0, width, COLUMNS):
        a, b = np.searchsorted(number, [at, at + COLUMNS])
        part = np.zeros((len(sets), min(COLUMNS, width - at)), dtype=np.float32)
        part[owner[a:b], number[a:b] - at] = 1
        counts += part @ part.T
    return counts


def unmet(roots: np.ndarray, side: np.ndarray, grid: np.ndarray, bucket: int) -> np.ndarray:
    """The pairs to compare in a cell, members of two blocks or of one (``side`` all equal): of different roots, and with no earlier bucket in common."""
    apart = roots[:, None] != roots[None]
    apart &= (side[:, None] < side[None]) if side.min() < side.max() else np.triu(np.ones(apart.shape, dtype=bool), 1)
    for k in range(int(np.flatnonzero(grid[0] == bucket)[0])):
        apart &= grid[:, k, None] != grid[None, :, k]
    return apart


def cell_links(sets: list[np.ndarray], roots: list[int], apart: np.ndarray, floor: float, test: Callable[[np.ndarray, np.ndarray], bool] | None) -> list[tuple[int, int]]:
    """Links between roots that join what is similar among the pairs ``apart``."""
    sizes = np.array([len(s) for s in sets])
    need = floor / (1 + floor) * (sizes[:, None] + sizes[None]) - 1e-6
    apart = apart & (np.minimum(sizes[:, None], sizes[None]) >= need)
    asked = apart.any(0) | apart.any(1)
    if not asked.any():
        return []
    apart, need, at = apart[asked][:, asked], need[asked][:, asked], np.flatnonzero(asked).tolist()
    apart = apart & (shared_counts([sets[i] for i in at]) >= need)
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    links = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(apart)), strict=True):
        x, y = at[i], at[j]
        a, b = find(roots[x]), find(roots[y])
        if a != b and (test is None or test(sets[x], sets[y])):
            parent[max(a, b)] = min(a, b)
            links.append((roots[x], roots[y]))
    return links


def block_links(open_: DataFrame, entries: DataFrame, floor: float, content: Content) -> DataFrame:
    """``ra, rb``: links between the roots of all similar pairs that share a bucket of ``open_(bucket, id, n, root)``.

    ``entries(id, entries)`` has the buckets of each id in one fixed order. A
    small bucket is one cell, and goes to the task of its smallest id, where
    it meets other buckets of the same ids; of a large one, each two blocks
    are a cell but for those of its commonest component alone.
    """
    weight = open_.select("id", "root").distinct().groupBy("root").agg(F.count("*").alias("weight"))
    main = open_.join(weight, "root").groupBy("bucket").agg(F.max(F.struct("weight", "root"))["root"].alias("main"), F.min("id").alias("first"), ((F.count("*") <= BLOCK_ROWS) & (F.sum("n") <= BLOCK_SIZE)).alias("small"))
    held = open_.join(main, "bucket").withColumn("is_main", (F.col("root") == F.col("main")) & ~F.col("small"))
    of = lambda main: F.greatest(F.ceil(F.sum(F.when(F.col("is_main") == main, 1).otherwise(0)) / BLOCK_ROWS), F.ceil(F.sum(F.when(F.col("is_main") == main, F.col("n")).otherwise(0)) / BLOCK_SIZE))
    blocks = held.groupBy("bucket").agg(of(True).cast("int").alias("mains"), of(False).cast("int").alias("rests"))
    dealt = held.join(blocks, "bucket").withColumn("own", F.pmod(F.xxhash64("id"), F.when(F.col("is_main"), F.col("mains")).otherwise(F.col("rests"))).cast("int"))
    dealt = dealt.withColumn("own", F.col("own") + F.when(F.col("is_main"), F.col("rests")).otherwise(0))
    last = F.col("rests") - 1 + F.when(F.col("is_main"), 0).otherwise(F.col("mains"))
    other = F.explode(F.sequence(F.lit(0), last)).alias("other")
    key = F.when(F.col("small"), F.xxhash64("first")).otherwise(F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other"))).alias("key")
    at = dealt.select("bucket", "id", "n", "root", "own", "first", "small", other)
    cells = materialize(at.select("bucket", "id", "n", "root", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), key), "cells")
    size = cells.agg(F.sum("n")).first()[0] or 0
    tasks = max(1, -(-size // TASK_SIZE))
    # An id's entries and text are joined once, and reach a task once, however many of its cells there.
    known = entries.join(cells.select("id").distinct(), "id", "left_semi").dropDuplicates(["id"])
    places = cells.groupBy(F.pmod("key", F.lit(tasks)).alias("task"), "id", "root").agg(F.collect_list(F.struct("bucket", "lo", "hi", "own")).alias("at"))
    full = materialize(places, "places").join(known.join(content.texts, "id"), "id").select("task", "id", "root", "entries", "text", *(F.col(f"at.{c}").alias(c) for c in ("bucket", "lo", "hi", "own")))
    sets_of, test = content.sets, content.test

    def compare(task: pd.DataFrame) -> pd.DataFrame:
        entry = np.repeat(np.arange(len(task)), task["bucket"].map(len))
        bucket, lo, hi, side = (np.concatenate(task[c].to_list()) for c in ("bucket", "lo", "hi", "own"))
        known_ids = task["id"].to_numpy()
        by = np.lexsort((known_ids[entry], hi, lo, bucket))
        entry, bucket, lo, hi, side = (x[by] for x in (entry, bucket, lo, hi, side))
        ids, roots = known_ids[entry], task["root"].to_numpy()[entry]
        cell = np.stack((bucket, lo, hi))
        cuts = [*np.flatnonzero((np.diff(cell, axis=1) != 0).any(0)) + 1, len(ids)]
        width = task["entries"].map(len).max()
        grid = np.arange(len(task) * width, dtype=np.int64).reshape(-1, width)  # missing entries equal none
        for i, e in enumerate(task["entries"]):
            grid[i, : len(e)] = e
        asked = []
        for a, b in zip([0, *cuts[:-1]], cuts, strict=True):
            apart = unmet(roots[a:b], side[a:b], grid[entry[a:b]], bucket[a])
            if apart.any():
                own = np.flatnonzero(apart.any(0) | apart.any(1))
                asked.append((own + a, apart[own][:, own]))
        texts = dict(zip(known_ids.tolist(), task["text"], strict=True))
        wanted = list(dict.fromkeys(i for own, _ in asked for i in ids[own].tolist()))
        sets = dict(zip(wanted, sets_of([texts[i] for i in wanted]), strict=True))
        links = {x for own, apart in asked for x in cell_links([sets[i] for i in ids[own].tolist()], roots[own].tolist(), apart, floor, test)}
        return pd.DataFrame(sorted(links), columns=["ra", "rb"], dtype="int64")

    return full.groupBy("task").applyInPandas(compare, "ra long, rb long")


def near_links(live: DataFrame, entries: DataFrame, floor: float, content: Content, first_share: int) -> DataFrame:
    """``id, root`` of every id with a verified link.

    The first round takes one bucket in ``first_share`` and one leader, the
    second every bucket and two leaders, the ends of an order of their
    components. What buckets of over three members still hold apart is
    compared in blocks.
    """
    tested, roots = None, None

    def merged(links: DataFrame) -> DataFrame:
        # Links join the components known so far: what was connected stays, under the new root.
        found = components(links.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
        if roots is None:
            return found
        moved = found.select(F.col("id").alias("was"), F.col("root").alias("now"))
        renamed = roots.join(moved, F.col("root") == F.col("was"), "left").select("id", F.coalesce("now", "root").alias("root"))
        return materialize(renamed.unionAll(found.join(roots.select("id"), "id", "left_anti")), "roots")

    def opened(live: DataFrame) -> DataFrame:
        return live.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))

    for turn, number in enumerate((1, 2)):
        named = opened(live) if turn else live.where(F.pmod("bucket", F.lit(first_share)) == 0).withColumn("root", F.col("id"))
        order = F.struct((F.xxhash64("root") if turn else F.col("root")).alias("h"), "root", "id", "n")
        ends = [f(order).alias(f"l{k}") for k, f in enumerate((F.min, F.max)[:number])]
        lead = named.groupBy("bucket").agg(*ends, F.max("root").alias("most"), F.min("root").alias("least"), F.count("*").alias("members")).where("least <> most").drop("most", "least")
        met = named.join(lead, "bucket")
        if turn:
            met = materialize(met, "open")
            live = met.where("members > 3").select("bucket", "id", "n")
        met = met.withColumn("l", F.explode(F.array(*(f"l{k}" for k in range(number))))).where("root <> l.root")
        fit = F.least("n", "l.n") >= floor * F.greatest("n", "l.n") - 1e-9 if content.sized else F.lit(True)
        pairs = met.where(fit).select(F.least("id", "l.id").alias("a"), F.greatest("id", "l.id").alias("b"), F.least("root", "l.root").alias("ra"), F.greatest("root", "l.root").alias("rb")).dropDuplicates(["a", "b"])
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        tested = pairs.select("a", "b")
        roots = merged(content.verify(pairs))
    named = opened(live)
    several = named.groupBy("bucket").agg(F.max("root").alias("most"), F.min("root").alias("least")).where("least <> most").select("bucket")
    rest = materialize(named.join(several, "bucket", "left_semi"), "rest")
    return roots if rest.isEmpty() else merged(materialize(block_links(rest, entries, floor, content), "links"))
