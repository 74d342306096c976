"""Masks as rows of runs: unions, shared areas, owners, boundaries, polygons and the compressed text form, with no mask decoded.

A run ``start, stop`` is a stretch of pixels, column after column, the end not
included; a mask is the runs of a key. Its runs meet in no group: they are
swept in order by windows, cut at blocks or columns where they are compared.
Masks without pixels have no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators.match import greedy
from tessera.sources.shared import materialize

LONG = "long"


def mask_runs(df: DataFrame, keys: Sequence[str], counts: str = "counts") -> DataFrame:
    """``keys, start, stop`` from uncompressed run lengths, the first of zeros. Empty runs of ones vanish, and what they part is one run."""
    each = df.select(*keys, F.posexplode(counts).alias("at", "n"))
    upto = F.sum("n").over(W.partitionBy(*keys).orderBy("at").rowsBetween(W.unboundedPreceding, 0))
    ones = each.withColumn("stop", upto.cast(LONG)).where("at % 2 = 1 and n > 0")
    return united(ones.select(*keys, (F.col("stop") - F.col("n")).cast(LONG).alias("start"), "stop"), keys)


def run_counts(runs: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """``keys, counts`` from the runs of a mask of ``size`` pixels, the inverse of ``mask_runs``."""
    ends = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("start", "stop"))), lambda r: F.array(r["start"], r["stop"])))
    whole = runs.groupBy(*keys).agg(ends.alias("ends"))
    whole = whole.withColumn("ends", F.when(F.element_at("ends", -1) < size, F.concat("ends", F.array(F.lit(size).cast(LONG)))).otherwise(F.col("ends")))
    return whole.select(*keys, F.transform("ends", lambda e, i: e - F.when(i == 0, F.lit(0)).otherwise(F.get("ends", i - 1))).alias("counts"))


def swept(rows: DataFrame, keys: Sequence[str], sets: int = 1, at: str = "start", to: str = "stop") -> DataFrame:
    """``keys, at, to, c0, ...``: stretches between the ends of intervals, and how many intervals of each set cover them. ``set`` is the set of a row."""
    of = (lambda k: F.col("set") == k) if sets > 1 else (lambda k: F.lit(True))
    ends = F.explode(F.array(F.struct(F.col(at).alias("at"), F.lit(1).alias("d")), F.struct(F.col(to).alias("at"), F.lit(-1).alias("d"))))
    each = rows.where(F.col(at) < F.col(to)).withColumn("end", ends)
    steps = each.groupBy(*keys, F.col("end.at").alias(at)).agg(*(F.sum(F.when(of(k), F.col("end.d")).otherwise(0)).alias(f"c{k}") for k in range(sets)))
    w = W.partitionBy(*keys).orderBy(at)
    so_far = w.rowsBetween(W.unboundedPreceding, 0)
    return steps.select(*keys, F.col(at), F.lead(at).over(w).alias(to), *(F.sum(f"c{k}").over(so_far).alias(f"c{k}") for k in range(sets))).where(F.col(to).isNotNull())


def united(runs: DataFrame, keys: Sequence[str], at: str = "start", to: str = "stop") -> DataFrame:
    """Runs of a key that overlap or touch as one: the union of its masks."""
    w = W.partitionBy(*keys).orderBy(at, to)
    reach = F.max(to).over(w.rowsBetween(W.unboundedPreceding, -1))
    new = runs.where(F.col(at) < F.col(to)).withColumn("__new", F.when(F.col(at) <= reach, 0).otherwise(1))
    island = new.withColumn("__island", F.sum("__new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return island.groupBy(*keys, "__island").agg(F.min(at).alias(at), F.max(to).alias(to)).drop("__island")


def areas(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    return runs.groupBy(*keys).agg(F.sum(F.col("stop") - F.col("start")).alias("area"))


def blocks(runs: DataFrame, width: int) -> DataFrame:
    """Runs cut at multiples of ``width`` pixels, with the ``block`` of each piece."""
    cut = runs.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("stop") - 1) / width))))
    first, after = F.col("block") * width, (F.col("block") + 1) * width
    return cut.withColumn("start", F.greatest("start", first)).withColumn("stop", F.least("stop", after))


def shared_areas(runs: DataFrame, image: Sequence[str], obj: str, width: int = 256) -> DataFrame:
    """``image, a, b, shared``: the pixels that two masks of an image share, of those that share any, a < b.

    Runs meet block by block, so neither an image nor a mask is held anywhere
    as a whole, and masks that are apart never meet.
    """
    pieces = blocks(runs.select(*image, obj, "start", "stop"), width)
    x = pieces.select(*image, "block", F.col(obj).alias("a"), "start", "stop")
    y = pieces.select(*image, "block", F.col(obj).alias("b"), F.col("start").alias("start_b"), F.col("stop").alias("stop_b"))
    met = x.join(y, [*image, "block"]).where("a < b and start < stop_b and start_b < stop")
    return met.groupBy(*image, "a", "b").agg(F.sum(F.least("stop", "stop_b") - F.greatest("start", "start_b")).alias("shared"))


def ious(runs: DataFrame, image: Sequence[str], obj: str) -> DataFrame:
    """``image, a, b, shared, iou, iom`` of the masks that share pixels; the smaller area counts as 1 at least."""
    size = areas(runs, [*image, obj])
    sizes = [size.select(*image, F.col(obj).alias(k), F.col("area").alias(f"area_{k}")) for k in ("a", "b")]
    both = shared_areas(runs, image, obj).join(sizes[0], [*image, "a"]).join(sizes[1], [*image, "b"])
    smaller = F.greatest(F.lit(1), F.least("area_a", "area_b"))
    return both.select(*image, "a", "b", "shared", (F.col("shared") / (F.col("area_a") + F.col("area_b") - F.col("shared"))).alias("iou"), (F.col("shared") / (smaller + 1e-8)).alias("iom"))


def keep_apart(items: DataFrame, runs: DataFrame, image: Sequence[str], obj: str, limit: float = 0.3) -> DataFrame:
    """``items`` with ``keep``: of masks of an image that share more than ``limit`` of the smaller one, the better stays.

    Best first by ``score``, then smaller id. Only masks that conflict meet in
    order; a mask alone, or without pixels, stays.
    """
    conflicts = ious(runs, image, obj).where(F.col("iom") > limit)
    return greedy(items, conflicts.select(*image, F.col("a").cast(LONG).alias("a"), F.col("b").cast(LONG).alias("b")), list(image), obj)


def owned_runs(runs: DataFrame, image: Sequence[str], obj: str, score: str, width: int = 1 << 16) -> DataFrame:
    """``image, obj, start, stop``: each pixel's best object by score, then smaller id, as runs; a null score is the worst.

    A sweep along the runs of an image with a heap of those that cover the
    place. Images are cut into blocks of ``width`` pixels, which are swept
    apart, so a large image is no large task; the heap holds what covers one pixel.
    """
    kinds = {c: runs.schema[c].dataType.simpleString() for c in (*image, obj)}
    n = len(image) + 1

    def sweep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, heap, at, out = None, [], 0, []

        def upto(end: float) -> None:
            nonlocal at
            while heap and at < end:
                _, one, stop = heap[0]
                if stop <= at:
                    heapq.heappop(heap)
                    continue
                to = min(stop, end)
                if out and out[-1][:n] == (*key[:-1], one) and out[-1][-1] == at:
                    out[-1] = (*out[-1][:-1], to)
                else:
                    out.append((*key[:-1], one, at, to))
                at = to

        def taken() -> pd.DataFrame:
            return pd.DataFrame(out, columns=[*image, obj, "start", "stop"])

        for f in frames:
            for *here, one, value, start, stop in zip(*(f[c].tolist() for c in f.columns), strict=True):
                if here != key:
                    upto(float("inf"))
                    key, heap, at = here, [], start
                upto(start)
                at = max(at, start)
                heapq.heappush(heap, (-value, one, stop))
            done, out = taken(), []
            yield done
        upto(float("inf"))
        yield taken()

    value = F.coalesce(F.col(score).cast("double"), F.lit(float("-inf"))).alias("value")
    dealt = blocks(runs, width).select(*image, "block", obj, value, "start", "stop").repartition(*image, "block").sortWithinPartitions(*image, "block", "start")
    schema = ", ".join([*(f"{c} {k}" for c, k in kinds.items()), "start long, stop long"])
    return united(dealt.mapInPandas(sweep, schema), [*image, obj])


def columns(runs: DataFrame, height: int) -> DataFrame:
    """Runs cut at columns: ``x`` and the rows ``y0`` to ``y1``, the end not included."""
    cut = blocks(runs, height)
    return cut.select(*(c for c in runs.columns if c not in ("start", "stop")), F.col("block").alias("x"), (F.col("start") - F.col("block") * height).alias("y0"), (F.col("stop") - F.col("block") * height).alias("y1"))


def boundary(cols: DataFrame, keys: Sequence[str], height: int, width: int) -> DataFrame:
    """Pixels that differ from the one to the right, below, or both; past an edge the edge goes on. ``keys, x, y0, y1``.

    The mask and its three shifted copies are four sets swept together.
    """
    one = lambda k, x, y0, y1: F.struct(F.lit(k).alias("set"), x.alias("x"), y0.alias("y0"), y1.alias("y1"))
    x, y0, y1 = F.col("x"), F.col("y0"), F.col("y1")
    up = (F.greatest(y0 - 1, F.lit(0)), F.when(y1 == height, y1).otherwise(y1 - 1))
    copies = [one(0, x, y0, y1), one(2, x, *up), one(1, x - 1, y0, y1), one(3, x - 1, *up)]
    last = [one(1, x, y0, y1), one(3, x, *up)]  # the last column is its own neighbour
    moved = F.when(x == width - 1, F.array(*copies, *last)).otherwise(F.array(*copies))
    each = cols.select(*keys, F.explode(moved).alias("c")).select(*keys, "c.set", "c.x", "c.y0", "c.y1").where("x >= 0")
    inside = [F.col(f"c{k}") > 0 for k in range(4)]
    differs = (inside[0] != inside[1]) | (inside[0] != inside[2]) | (inside[0] != inside[3])
    return swept(each, [*keys, "x"], 4, "y0", "y1").where(differs).select(*keys, "x", "y0", "y1")


def dilated(cols: DataFrame, radius: int, height: int, width: int) -> DataFrame:
    """Grown by a square of side 2 * ``radius`` + 1, cut at the edges; pieces may overlap."""
    spread = cols.withColumn("x", F.explode(F.sequence(F.greatest(F.col("x") - radius, F.lit(0)), F.least(F.col("x") + radius, F.lit(width - 1)))))
    return spread.withColumn("y0", F.greatest(F.col("y0") - radius, F.lit(0))).withColumn("y1", F.least(F.col("y1") + radius, F.lit(height)))


def common_area(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, area``: pixels in both of two sets of column pieces, each of which may overlap itself."""
    both = a.select(*keys, "x", "y0", "y1", F.lit(0).alias("set")).unionByName(b.select(*keys, "x", "y0", "y1", F.lit(1).alias("set")))
    return swept(both, [*keys, "x"], 2, "y0", "y1").where("c0 > 0 and c1 > 0").groupBy(*keys).agg(F.sum(F.col("y1") - F.col("y0")).alias("area"))


def boundary_scores(pairs: DataFrame, truth: DataFrame, found: DataFrame, keys: Sequence[str], height: int, width: int, radius: int = 1) -> DataFrame:
    """``pairs`` (one row a matched pair of masks) with ``j``, their IoU, and ``f``, the F measure of their boundaries within ``radius``.

    A side without boundary: the precision or recall that lacks it is 1; both
    0 give 0. Two masks without pixels have a ``j`` of 0.
    """
    side, edge, whole = {}, {}, {}
    for name, runs in (("t", truth), ("d", found)):
        side[name] = columns(runs.select(*keys, "start", "stop"), height)
        edge[name] = materialize(boundary(side[name], keys, height, width), "edges")  # read three times
        whole[name] = edge[name].groupBy(*keys).agg(F.sum(F.col("y1") - F.col("y0")).alias(f"n_{name}"))
    out = pairs
    near = {"t": common_area(edge["t"], dilated(edge["d"], radius, height, width), keys), "d": common_area(edge["d"], dilated(edge["t"], radius, height, width), keys)}
    for name in ("t", "d"):
        out = out.join(whole[name], list(keys), "left").join(near[name].withColumnRenamed("area", f"near_{name}"), list(keys), "left")
        out = out.join(areas({"t": truth, "d": found}[name], list(keys)).withColumnRenamed("area", f"area_{name}"), list(keys), "left")
    out = out.join(common_area(side["t"], side["d"], keys).withColumnRenamed("area", "shared"), list(keys), "left")
    z = lambda c: F.coalesce(c, F.lit(0))
    share = lambda name, other: F.when(z(f"n_{name}") > 0, z(f"near_{name}") / F.col(f"n_{name}")).otherwise(F.lit(1.0))
    p, r = share("d", "t"), share("t", "d")
    united_area = z("area_t") + z("area_d") - z("shared")
    j = F.when(united_area > 0, z("shared") / united_area).otherwise(F.lit(0.0))
    return out.select(*pairs.columns, j.alias("j"), F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0)).alias("f"))


def mean_boundary_scores(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, n, j, f, jf``: means over a key's matched pairs, and the mean of both; a key whose pairs are all null has -1 in each."""
    n = F.count("j")
    mean = lambda c: F.when(n > 0, F.sum(c) / (n + 1e-9)).otherwise(F.lit(-1.0))
    out = scored.groupBy(*keys).agg(n.alias("n"), F.coalesce(F.avg("j"), F.lit(-1.0)).alias("j"), mean("f").alias("f"))
    return out.withColumn("jf", F.when(F.col("n") > 0, (F.col("j") + F.col("f")) * 0.5).otherwise(F.lit(-1.0)))


def polygon_runs(df: DataFrame, keys: Sequence[str], parts: str, height: int, width: int) -> DataFrame:
    """``keys, start, stop``: the pixels whose centre lies in a polygon, even-odd, of any of the key's ``parts`` (x0, y0, x1, y1, ...).

    A scan line a column: edges cross the line through the column's centres,
    and between an odd crossing and the next one lies the inside. Parts of
    fewer than three corners have none; what is outside the image is cut off.
    """
    return _polygon_rows(df, keys, parts, F.lit(height), F.lit(width))


def _polygon_rows(df: DataFrame, keys: Sequence[str], parts: str, height: Column, width: Column) -> DataFrame:
    df = df.select(*keys, parts, height.alias("__h"), width.alias("__w"))
    height, width = F.col("__h"), F.col("__w")
    keys, given = [*keys, "__h", "__w"], keys
    each = df.select(*keys, F.posexplode(parts).alias("part", "p")).where(F.size("p") >= 6)
    n = (F.size("p") / 2).cast("int")
    at = lambda i, k: F.get("p", (i % n) * 2 + k).cast("double")
    edges = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(at(i, 0).alias("x1"), at(i, 1).alias("y1"), at(i + 1, 0).alias("x2"), at(i + 1, 1).alias("y2")))
    each = each.select(*keys, "part", F.explode(edges).alias("e")).select(*keys, "part", "e.*")
    first = F.greatest(F.ceil(F.least("x1", "x2") - 0.5), F.lit(0))
    last = F.least(F.ceil(F.greatest("x1", "x2") - 0.5) - 1, width - 1)
    each = each.where(first <= last).withColumn("x", F.explode(F.sequence(first, last)))
    y = F.col("y1") + (F.col("x") + 0.5 - F.col("x1")) * (F.col("y2") - F.col("y1")) / (F.col("x2") - F.col("x1"))
    row = F.least(F.greatest(F.ceil(y - 0.5), F.lit(0)), height)
    w = W.partitionBy(*keys, "part", "x").orderBy("y0")
    pairs = each.select(*keys, "part", "x", row.alias("y0")).select(*keys, "x", "y0", F.lead("y0").over(w).alias("y1"), F.row_number().over(w).alias("k")).where("k % 2 = 1 and y0 < y1")
    return united(pairs.select(*given, (F.col("x") * height + F.col("y0")).alias("start"), (F.col("x") * height + F.col("y1")).alias("stop")), given)


def segmentation_runs(annotations: DataFrame, keys: Sequence[str], text: str = "segmentation") -> DataFrame:
    """``keys, start, stop`` of annotations whose JSON ``text`` holds polygons, run lengths or their text form, in an image of ``height`` and ``width``.

    Polygons are filled for each size of image that occurs, as rows. Null, empty and unreadable texts have no pixels.
    """
    said = annotations.select(*keys, "height", "width", F.trim(text).alias("said")).where("said is not null")
    parts = F.from_json("said", "array<array<double>>")
    drawn = said.where(F.col("said").startswith("[")).select(*keys, "height", "width", parts.alias("parts"))
    rle = said.where(F.col("said").startswith("{")).select(*keys, F.from_json("said", "counts string").alias("r")).select(*keys, F.col("r.counts").alias("counts"))
    listed = rle.where(F.col("counts").startswith("[")).select(*keys, F.from_json("counts", "array<bigint>").alias("counts"))
    coded = decompressed(rle.where(~F.col("counts").startswith("[")), keys, "counts")
    return _polygon_rows(drawn, keys, "parts", F.col("height").cast(LONG), F.col("width").cast(LONG)).unionByName(mask_runs(listed.unionByName(coded), keys))


# The text form keeps five bits a letter from this one on, 32 marks a letter that is not a number's last.
FIRST_LETTER, BITS, MORE, SIGN, MOST_LETTERS = 48, 5, 32, 16, 13


def compressed(counts: Column) -> Column:
    """Run lengths in their text form: from the fourth on the difference to the one two before, the lowest five bits first."""
    number = lambda c, i: (c - F.when(i > 2, F.get(counts, i - 2)).otherwise(F.lit(0))).cast(LONG)
    shifted = lambda x, k: F.call_function("shiftright", x, (k * BITS).cast("int"))
    # The last letter is the first after which only copies of its sign bit are left.
    last = lambda x, k: shifted(x, k + 1) == F.when(shifted(x, k).bitwiseAND(F.lit(SIGN)) > 0, F.lit(-1)).otherwise(F.lit(0))

    def letters(x: Column) -> Column:
        n = F.element_at(F.filter(F.sequence(F.lit(0), F.lit(MOST_LETTERS - 1)), lambda k: last(x, k)), 1)
        return F.array_join(F.transform(F.sequence(F.lit(0), n), lambda k: F.char((shifted(x, k).bitwiseAND(F.lit(MORE - 1)) + F.when(k < n, MORE).otherwise(0) + FIRST_LETTER).cast("int"))), "")

    return F.array_join(F.transform(F.transform(counts, number), letters), "")


def decompressed(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """``keys, counts`` from the text form; an empty text has no runs."""
    letters = df.select(*keys, F.posexplode(F.split(text, "")).alias("at", "letter")).where("letter <> ''").withColumn("v", F.ascii("letter") - FIRST_LETTER)
    w = W.partitionBy(*keys).orderBy("at")
    ended = F.when(F.col("v").bitwiseAND(F.lit(MORE)) == 0, 1).otherwise(0)
    numbered = letters.withColumn("i", F.coalesce(F.sum(ended).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).cast("int"))
    numbered = numbered.withColumn("k", (F.row_number().over(W.partitionBy(*keys, "i").orderBy("at")) - 1).cast("int"))
    low = F.col("v").bitwiseAND(F.lit(MORE - 1)).cast(LONG)
    value = F.call_function("shiftleft", low, F.col("k") * BITS)
    sign = F.when((ended == 1) & (low.bitwiseAND(F.lit(SIGN)) > 0), -F.call_function("shiftleft", F.lit(1).cast(LONG), (F.col("k") + 1) * BITS)).otherwise(F.lit(0))
    numbers = numbered.groupBy(*keys, "i").agg(F.sum(value + sign).alias("x"))
    # Even and odd places are two chains of differences; the first number stands apart.
    chain = F.when(F.col("i") == 0, -1).otherwise(F.col("i") % 2)
    counts = numbers.withColumn("c", F.sum("x").over(W.partitionBy(*keys, chain).orderBy("i").rowsBetween(W.unboundedPreceding, 0)))
    whole = counts.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "c"))), lambda s: s["c"]).alias("counts"))
    empty = F.array().cast("array<bigint>")
    return df.select(*keys).join(whole, list(keys), "left").withColumn("counts", F.coalesce("counts", empty))
