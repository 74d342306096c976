"""Nearest neighbours by a forest of random-projection trees and one priority queue over all of them.

The trees are split on a bounded sample; every row is then indexed, by the
leaf it falls into in each tree. A query takes leaves from all trees in order
of the largest margin by which it lies on the other side of a split, until
the leaves hold a set share of all rows. That share is tuned on the sample
for the target recall, so it is small where the data have structure. Leaf
candidates are then ranked by exact distance.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .storage import materialize

SHARES = (0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65, 0.7, 0.8, 0.9, 1.0)


@dataclass
class Tree:
    """Splits in arrays: row i goes left where normal[i] @ x <= at[i]; a child below 0 is leaf -1 - child."""

    normal: np.ndarray
    at: np.ndarray
    left: np.ndarray
    right: np.ndarray
    leaves: int

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), dtype=np.int64) if len(self.at) else np.full(len(x), -1)
        while (inner := node >= 0).any():
            here = node[inner]
            low = (self.normal[here] * x[inner]).sum(1) <= self.at[here]
            node[inner] = np.where(low, self.left[here], self.right[here])
        return -1 - node


def grow(x: np.ndarray, leaf_size: int, rng: np.random.Generator, tries: int = 8) -> Tree:
    """Splits at the median along the difference of two sampled rows, of ``tries`` such the one with the most spread."""
    normal, at, left, right, leaves = [], [], [], [], 0

    def split(rows: np.ndarray) -> int:
        nonlocal leaves
        best = None
        if len(rows) > leaf_size:
            some = x[rng.choice(rows, min(len(rows), 256), replace=False)]
            for _ in range(tries):
                a, b = rng.choice(len(some), 2, replace=False)
                length = np.linalg.norm(some[a] - some[b])
                if length:
                    w = (some[a] - some[b]) / length
                    if best is None or (some @ w).var() > best[0]:
                        best = ((some @ w).var(), w)
        if best is not None:
            sides = x[rows] @ best[1]
            cut = float(np.median(sides))
            low = sides <= cut
            if low.any() and not low.all():
                here = len(at)
                normal.append(best[1])
                at.append(cut)
                left.append(0)
                right.append(0)
                left[here] = split(rows[low])
                right[here] = split(rows[~low])
                return here
        leaves += 1
        return -leaves

    split(np.arange(len(x)))
    return Tree(np.array(normal).reshape(-1, x.shape[1]), np.array(at), np.array(left, dtype=np.int64), np.array(right, dtype=np.int64), leaves)


def visit(forest: list[Tree], sizes: list[np.ndarray], query: np.ndarray, share: float) -> Iterator[tuple[int, int]]:
    """(tree, leaf) by margin, smallest first over all trees, until the leaves should hold ``share`` of the rows."""
    total = max(1, int(sizes[0].sum()))
    missed = [1.0] * len(forest)
    queue = [(0.0, t, 0 if len(tree.at) else -1) for t, tree in enumerate(forest)]
    while queue and 1 - np.prod(missed) < share:
        margin, t, node = heapq.heappop(queue)
        tree = forest[t]
        while node >= 0:
            side = float(tree.normal[node] @ query - tree.at[node])
            near, far = (tree.left[node], tree.right[node]) if side <= 0 else (tree.right[node], tree.left[node])
            heapq.heappush(queue, (max(margin, abs(side)), t, int(far)))
            node = int(near)
        missed[t] -= sizes[t][-1 - node] / total
        yield t, -1 - node


def squared(queries: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances, and for each query a bound of their rounding error; what all vectors have in common is taken off first."""
    middle = rows.mean(0)
    q, x = queries - middle, rows - middle
    qq, xx = (q**2).sum(1), (x**2).sum(1)
    error = 4 * (x.shape[1] + 4) * np.finfo(np.float64).eps * (np.sqrt(qq) + np.sqrt(xx.max(initial=0.0)) + np.sqrt(x.shape[1]) * np.abs(middle).max(initial=0.0) * np.finfo(np.float64).eps) ** 2
    return np.maximum(qq[:, None] + xx[None] - 2 * q @ x.T, 0), error


def tuned_share(forest: list[Tree], x: np.ndarray, k: int, target: float, n_queries: int = 200) -> float:
    """The least of SHARES at which the queries of the sample find ``target`` of their ``k`` nearest in it."""
    chosen = np.linspace(0, len(x) - 1, min(n_queries, len(x))).astype(int)
    leaf = [tree.leaf_of(x) for tree in forest]
    sizes = [np.bincount(a, minlength=t.leaves) for a, t in zip(leaf, forest, strict=True)]
    apart = squared(x[chosen], x)[0]
    apart[np.arange(len(chosen)), chosen] = np.inf
    near = np.argsort(apart, axis=1)[:, :k]
    for share in SHARES:
        found = 0
        for q, true in zip(chosen, near, strict=True):
            seen = np.zeros(len(true), dtype=bool)
            for t, number in visit(forest, sizes, x[q], share):
                seen |= leaf[t][true] == number
            found += int(seen.sum())
        if found >= target * near.size:
            return share
    return 1.0


def nearest(df: DataFrame, k: int = 10, every: int = 100, trees: int = 4, sample_rows: int = 5000, leaf_rows: int = 1024, block_rows: int = 4096, query_block: int = 2000, target: float = 0.96, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank (from 1), vec_id, score``: the ``k`` nearest found of each row whose id is divisible by ``every``.

    ``score`` is the Euclidean distance of the original vectors in double
    precision; ties go to the smaller id. Vectors that are null, zero, hold a
    null or non-finite component, or lack the commonest dimension take no
    part, nor do null ids; a repeated row counts once. Of equal vectors only
    the k + 1 smallest ids can be among the nearest, so a group of copies of
    any size adds no more. No usable row gives no rows. ``sample_rows`` bounds
    what the trees are fitted on; every row is indexed.
    """
    vector = F.col(vector_col).cast("array<double>")
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("v", lambda c: c != 0)
    usable = df.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(fine)
    dims = usable.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not dims:
        return df.sparkSession.createDataFrame([], schema)
    usable = usable.where(F.size("v") == dims[0]["d"]).dropDuplicates(["vec_id", "v"])
    first = W.partitionBy("v").orderBy("vec_id")
    rows = materialize(usable.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1).drop("nth"), "vectors")
    queries = usable.where(F.col("vec_id") % every == 0)
    n_rows = rows.count()
    sample = np.array([r["v"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).collect()])
    rng = np.random.default_rng(11)
    forest = [grow(sample, max(16, leaf_rows * len(sample) // n_rows), rng) for _ in range(trees)]
    share = tuned_share(forest, sample, k, target)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array(batch.column("v").flatten()).reshape(batch.num_rows, -1)
            for t, tree in enumerate(forest):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t)), pa.array(tree.leaf_of(x)), batch.column("vec_id"), batch.column("v")], names=["tree", "leaf", "vec_id", "v"])

    indexed = materialize(rows.mapInArrow(index, "tree long, leaf long, vec_id long, v array<double>"), "leaves")
    counts = indexed.groupBy("tree", "leaf").count().collect()  # bounded: the trees' leaves
    sizes = [np.zeros(tree.leaves, dtype=np.int64) for tree in forest]
    for r in counts:
        sizes[r["tree"]][r["leaf"]] = r["count"]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for query, v in zip(batch.column("vec_id").to_pylist(), batch.column("v").to_pylist(), strict=True):
                to = [(t, leaf, b) for t, leaf in visit(forest, sizes, np.array(v), share) for b in range(-(-int(sizes[t][leaf]) // block_rows))]
                columns = [*zip(*to, strict=True)] or [[]] * 3
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.array([query] * len(to), pa.int64()), pa.array([v] * len(to), pa.list_(pa.float64()))], names=["tree", "leaf", "block", "query_id", "q"])

    # A large leaf is cut into blocks, and queries into blocks of about query_block, so no group grows with the data.
    n_queries = queries.count()
    query_blocks = max(1, -(-n_queries // query_block))
    routed = queries.mapInArrow(route, "tree long, leaf long, block long, query_id long, q array<double>").withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)))
    routed = materialize(routed, "routes")
    leaf_count = F.element_at(F.element_at(F.array(*(F.array(*(F.lit(int(n)) for n in s)) for s in sizes)), F.col("tree").cast("int") + 1), F.col("leaf").cast("int") + 1)
    blocks = F.greatest(F.ceil(leaf_count / block_rows), F.lit(1))
    keys = ["tree", "leaf", "block", "qb"]
    placed = indexed.withColumn("block", F.pmod(F.xxhash64("vec_id"), blocks)).join(materialize(routed.select(keys).distinct(), "asked"), ["tree", "leaf", "block"])  # once for each block of queries that asks

    def rank(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        if len(asked) and len(held):
            x, ids = np.array(held["v"].tolist()), held["vec_id"].to_numpy()
            q, qid = np.array(asked["q"].tolist()), asked["query_id"].to_numpy()
            for at in range(0, len(q), 256):
                near, error = squared(q[at : at + 256], x)
                near[qid[at : at + 256, None] == ids[None]] = np.inf
                edge = np.partition(near, min(k, len(x)) - 1, axis=1)[:, min(k, len(x)) - 1]
                for i, kept in enumerate((near <= (edge + 2 * error)[:, None]) & np.isfinite(near)):
                    cols = np.flatnonzero(kept)  # whatever rounding could have kept out, and all ties
                    exact = np.sqrt(((x[cols] - q[at + i]) ** 2).sum(1))
                    order = np.lexsort((ids[cols], exact))[:k]
                    out.append(pd.DataFrame({"query_id": qid[at + i], "vec_id": ids[cols][order], "score": exact[order]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})

    found = routed.groupBy(*keys).cogroup(placed.groupBy(*keys)).applyInPandas(rank, "query_id long, vec_id long, score double").dropDuplicates(["query_id", "vec_id"])
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
