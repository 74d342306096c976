"""Mixing sources to target weights by nested hash thresholds, without sorting documents.

A source takes all its documents as often as its budget holds them whole, and
once more those whose hash is below a threshold. Words summed by source and
hash bucket tell in which bucket the threshold lies; only that bucket's
documents are summed again, by the next bits of the hash, until one hash is
left. The document of that hash is taken in part, to the word.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators.rank import global_rank

from .counting import n_words
from .storage import materialize

#: Bits of the hash, and bits of a bucket at each of the levels.
BITS, STEP = 60, 12
#: Sources, a fixed-width row each beside their names, up to which their table is sent to every task.
BROADCAST_ROWS, SALTS = 200_000, 64


def place(doc_id: Column, text: Column) -> Column:
    """60 bits of an MD5 of id and text: reruns agree, and copies under other ids are taken apart."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), text).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def beside(rows: DataFrame, sources: DataFrame, n: int) -> DataFrame:
    """Each row of ``none, source, h`` with what is known of its source; beyond BROADCAST_ROWS sources a large one is dealt in SALTS parts."""
    if n <= BROADCAST_ROWS:
        return rows.join(F.broadcast(sources), ["none", "source"])
    salted = rows.withColumn("salt", F.pmod("h", F.lit(SALTS)))
    spread = sources.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(spread, ["none", "source", "salt"]).drop("salt")


def shared_level(sources: DataFrame, share: float) -> float:
    """Words a unit of weight gets when ``share`` of all words is dealt by weight and what a source can't take is dealt again among the others.

    One row comes back a round; each round closes at least one source more.
    """
    total, weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    if not total:
        return 0.0
    budget, closed = share * total, 0
    level = budget / weights
    while True:
        full = F.lit(level) * F.col("weight") > F.col("cap")
        n, taken, left = sources.agg(F.count_if(full), F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0)), F.sum(F.when(~full, F.col("weight")))).first()
        if n == closed or not left:
            return level
        level, closed = (budget - taken) / left, n


def thresholds(rows: DataFrame, sources: DataFrame, n: int) -> DataFrame:
    """``none, source, edge, left, tied``: the hash in which the ``rest`` words of a source end, how many of them are its, and how many words it has."""
    found, spec = [], W.partitionBy("none", "source").orderBy("bucket")
    inside = beside(rows, sources.where("rest > 0").select("none", "source", F.col("rest").alias("left")), n)
    for shift in range(BITS - STEP, -1, -STEP):
        buckets = inside.groupBy("none", "source", "left", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("words"), F.min("h").alias("edge"), F.max("h").alias("last"))
        sums = buckets.withColumn("upto", F.sum("words").over(spec)).where((F.col("upto") > F.col("left")) & (F.col("upto") - F.col("words") <= F.col("left")))
        ends = materialize(sums.select("none", "source", "bucket", (F.col("left") - F.col("upto") + F.col("words")).alias("left"), F.col("words").alias("tied"), "edge", "last"), "edges")
        found.append(ends.where("edge = last").select("none", "source", "edge", "left", "tied"))
        open_ = ends.where("edge < last")
        if open_.isEmpty():
            break
        within = F.shiftright("h", shift) == F.col("bucket")
        inside = materialize(beside(inside.drop("left"), open_.select("none", "source", "bucket", "left"), n).where(within).drop("bucket"), "bucket")
    return reduce(DataFrame.unionAll, found)


def mix_sources(df: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, limit: int = 2) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of each row of ``doc_id, source, text``: ``taken`` words of it, repeats counted, are in the mix.

    Sizes are words between blanks; null text has none. Sources by code point,
    null last and a source of its own, weigh ``weights`` in turn. ``share``
    times all words is dealt by weight, no source above ``limit`` times its
    size; what it can't take is dealt again. A source's words are its target,
    rounded, but for rows of one id and text, which share what is left by size.
    Rows without words take none; without any words all targets are 0; an
    empty table gives none. Other columns don't matter. A source may hold any
    share of the rows: it is only ever summed by hash bucket.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = F.col("source").cast("string")
    rows = materialize(df.select(F.col("doc_id").cast("long").alias("doc_id"), source.isNull().alias("none"), F.coalesce(source, F.lit("")).alias("source"), n_words(text).alias("size"), place(F.col("doc_id").cast("long"), text).alias("h")), "sizes")
    sources = global_rank(rows.groupBy("none", "source").agg(F.sum("size").alias("source_size")), F.asc("none"), F.asc("source"))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("rn") - 1) % len(weights) + 1).cast("int"))
    sources = materialize(sources.select("none", "source", "source_size", weight.alias("weight"), (F.col("source_size") * limit).alias("cap")), "sources")
    level = F.lit(shared_level(sources, share))
    target = F.when(level * F.col("weight") > F.col("cap"), F.col("cap").cast("double")).otherwise(level * F.col("weight"))
    sources = sources.withColumn("target", target).withColumn("budget", F.floor(F.col("target") + 0.5))
    times = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0).cast("long"))
    sources = sources.withColumn("times", times).withColumn("rest", F.col("budget") - F.col("times") * F.col("source_size"))
    n = sources.count()
    known = sources.select("none", "source", "source_size", "target", "times").join(thresholds(rows, sources, n), ["none", "source"], "left")
    once = F.when(F.col("h") < F.col("edge"), F.col("size")).when(F.col("h") == F.col("edge"), F.expr("left * size div tied")).otherwise(F.lit(0).cast("long"))
    return beside(rows, known, n).select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size") + once).alias("taken"))
