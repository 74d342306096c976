"""Removal of long repeated byte strings, by suffix arrays over the places where repeats can be.

Two equal windows of ``length`` bytes hold the same smallest gram (by hash),
so windows are gathered in runs that share it. Runs that are equal as a whole
are repeats at once; a run whose gram stands nowhere else holds none. The few
runs left, those around an edit, are dealt by gram into shards. Each shard
sorts its suffixes by Larsson-Sadakane refinement, takes the common prefixes
of neighbours, and so finds the windows that it holds twice. Shards of one
gram too frequent for a single shard are merged by their windows' keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkeys as K
from .fuzzy_lines import with_row
from .storage import materialize

LENGTH = 200
GRAM = 64
WINDOW = LENGTH - GRAM + 1
#: Most rows of a few numbers sent to all executors; beyond, both sides of a join are dealt by its key.
BROADCAST_ROWS = 1_000_000
#: Bytes a shard holds in the mean, and most runs of one gram that stay in one shard.
SHARD_BYTES, SHARD_RUNS = 1 << 19, 1000
#: Windows in the mean of a range of keys, over all shards, that are merged together.
RANGE_WINDOWS = 1 << 20


def sliding_min(g: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each ``size`` consecutive values: of the rest of one block and the start of the next."""
    blocks = -(-len(g) // size)
    x = np.full(blocks * size, np.iinfo(np.uint64).max, dtype=np.uint64)
    x[: len(g)] = g
    x = x.reshape(blocks, size)
    before = np.minimum.accumulate(x, axis=1).ravel()
    after = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    at = np.arange(len(g) - size + 1)
    return np.minimum(after[at], before[at + size - 1])


def holds_twice(g: np.ndarray, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether the windows ``starts..ends`` of each run hold their smallest gram ``low`` at two places or more."""
    marks = np.zeros(1 << 16, dtype=bool)
    marks[(low & K.U64(0xFFFF)).astype(np.int64)] = True
    at = np.flatnonzero(marks[(g & K.U64(0xFFFF)).astype(np.int64)])
    values, number = np.unique(low, return_inverse=True)
    of = np.minimum(np.searchsorted(values, g[at]), len(values) - 1)
    same = values[of] == g[at]
    place = of[same] * (len(g) + 1) + at[same]
    place.sort()
    first = np.searchsorted(place, number * (len(g) + 1) + starts)
    last = np.searchsorted(place, number * (len(g) + 1) + ends - 1 + WINDOW - 1, "right")
    return last - first > 1


def runs_of(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start, windows, gram, digest, twice) of the runs of consecutive windows with the same smallest gram."""
    sums, inverse = K.prefix_keys(data)
    at = np.arange(len(data) - GRAM + 1)
    g = K.mix((sums[at + GRAM] - sums[at]) * inverse[at])
    low = sliding_min(g, WINDOW)
    starts = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
    ends = np.append(starts[1:], len(low))
    digest = K.span_keys(sums, inverse, starts, ends - 1 + LENGTH)
    return starts, ends - starts, low[starts].view(np.int64), digest.view(np.int64), holds_twice(g, low[starts], starts, ends)


def refine(text: np.ndarray, depth: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Suffix order of ``text`` by its first ``depth`` bytes at least, and the ranks at each doubling.

    Suffixes are first ranked by eight bytes; then groups of equal rank, and
    only they, are sorted by the rank as far ahead as is already compared.
    """
    n = len(text)
    padded = np.concatenate((text.astype(np.uint64), np.zeros(8, dtype=np.uint64)))
    key = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        key = (key << K.U64(8)) | padded[k : k + n]
    order = np.argsort(key, kind="stable")
    new = np.concatenate(([True], key[order][1:] != key[order][:-1]))
    # A rank is the place of its group's first suffix.
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    h, levels = 8, [(8, rank.copy())]
    while h < depth:
        at = np.arange(n)
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, n))
        tied = np.repeat(size > 1, size)
        rows = at[tied]
        if len(rows):
            suffix = order[rows]
            ahead = rank[np.minimum(suffix + h, n)]
            by = np.argsort(rank[suffix] * (n + 1) + ahead, kind="stable")
            suffix, ahead = suffix[by], ahead[by]
            order[rows] = suffix
            own = rank[suffix]
            new[rows] = np.concatenate(([True], (own[1:] != own[:-1]) | (ahead[1:] != ahead[:-1])))
            moved = np.maximum.accumulate(np.where(new, at, 0))
            rank[suffix] = moved[rows]
        h *= 2
        levels.append((h, rank.copy()))
    return order, levels


def neighbour_prefixes(order: np.ndarray, levels: list[tuple[int, np.ndarray]], text: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it in the order, up to ``cap``: Kasai's array, read off the refinement's levels."""
    n = len(order)
    a, b, common = order[1:].copy(), order[:-1].copy(), np.zeros(n, dtype=np.int64)
    for h, rank in reversed(levels):
        if h <= cap:
            equal = rank[np.minimum(a, n)] == rank[np.minimum(b, n)]
            step = h * (equal & (np.maximum(a, b) < n))
            common[1:] += step
            a, b = a + step, b + step
    padded = np.concatenate((text.astype(np.int64) + 1, np.arange(-17, 0)))
    alive = np.ones(n - 1, dtype=bool)
    for _ in range(7):  # what is left is shorter than the first level
        alive &= padded[np.minimum(a, n)] == padded[np.minimum(b, n + 1)]
        common[1:] += alive
        a, b = a + alive, b + alive
    return np.minimum(common, cap)


def runs(docs: DataFrame) -> DataFrame:
    """``row, start, windows, gram, digest, twice`` of every run of every whole text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "start", "windows", "gram", "digest", "twice"]
        for batch in batches:
            for part, data, offsets in K.pieces(batch, "text"):
                rows, found = part.column("row").to_numpy(), []
                for row, a, b in zip(rows, offsets[:-1], offsets[1:], strict=True):
                    if b - a >= LENGTH:
                        run = runs_of(data[a:b])
                        found.append((np.full(len(run[0]), row), *run))
                if found:
                    columns = [np.concatenate(c) for c in zip(*found, strict=True)]
                    columns[1:3] = [c.astype(np.int32) for c in columns[1:3]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return docs.mapInArrow(find, "row long, start int, windows int, gram long, digest long, twice boolean")


RESULT = "row long, start long, end long, part long, keys binary, rows binary, starts binary"


def shard_repeats(shard: pd.DataFrame, ranges: int) -> pd.DataFrame:
    """Repeated spans of a shard's open runs; for split grams also its distinct windows, sorted by key and cut into ``ranges``.

    A window that needs no answer, as it is known to repeat or is not open,
    has start -1: it may still answer for another shard's.
    """
    shard = shard.sort_values(["row", "start"], kind="stable")
    parts = [np.frombuffer(b, dtype=np.uint8) for b in shard["bytes"]]
    sizes = np.array([len(p) for p in parts])
    begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    text = np.concatenate(parts)
    order, levels = refine(text, 256)
    common = neighbour_prefixes(order, levels, text, LENGTH)
    klass = np.empty(len(text), dtype=np.int64)
    klass[order] = np.cumsum(common < LENGTH)
    owner = np.repeat(np.arange(len(parts)), sizes)
    offset = np.arange(len(text)) - begins[owner]
    whole = np.flatnonzero(offset <= sizes[owner] - LENGTH)  # windows that end in their own run
    klass, owner, offset = klass[whole], owner[whole], offset[whole]
    many = np.bincount(klass)[klass] > 1
    open_ = shard["open"].to_numpy()[owner]
    row, at = shard["row"].to_numpy()[owner], shard["start"].to_numpy()[owner] + offset
    hit = many & open_
    edge = hit & np.concatenate(([True], ~hit[:-1] | (owner[1:] != owner[:-1])))
    last = hit & np.concatenate((~hit[1:] | (owner[1:] != owner[:-1]), [True]))
    out = [pd.DataFrame({"row": row[edge], "start": at[edge], "end": at[last] + LENGTH}, dtype="Int64")]
    asked = np.zeros(len(klass), dtype=bool)
    asked[np.unique(klass, return_index=True)[1]] = True
    asked &= shard["split"].to_numpy()[owner]
    if asked.any():
        sums, inverse = K.prefix_keys(text)
        keys = K.span_keys(sums, inverse, whole[asked], whole[asked] + LENGTH)
        starts = np.where((open_ & ~many)[asked], at[asked], -1)
        by = np.argsort(keys)
        keys, rows, starts = keys[by], row[asked][by], starts[by]
        cuts = np.searchsorted(keys, np.array([k * 2**64 // ranges for k in range(ranges)], dtype=np.uint64))
        bounds = [*cuts, len(keys)]
        out.append(pd.DataFrame([(k, keys[a:b].tobytes(), rows[a:b].tobytes(), starts[a:b].tobytes()) for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if b > a], columns=["part", "keys", "rows", "starts"]))
    every = pd.concat(out, ignore_index=True).reindex(columns=[c.split()[0] for c in RESULT.split(", ")])
    numbers = every[["row", "start", "end", "part"]].astype("Int64")
    return numbers.join(every[["keys", "rows", "starts"]].astype(object).where(every[["keys", "rows", "starts"]].notna(), None))


def merge_shards(part: pd.DataFrame) -> pd.DataFrame:
    """``row, starts`` of the windows of one range of keys that another shard holds too: each shard's sorted keys are looked up in the others' by binary search."""
    keys = [np.frombuffer(b, np.uint64) for b in part["keys"]]
    merged = np.sort(np.concatenate(keys), kind="stable")
    found_rows, found_starts = [], []
    for own, rows, starts in zip(keys, part["rows"], part["starts"], strict=True):
        shared = np.searchsorted(merged, own, "right") - np.searchsorted(merged, own, "left") > 1
        starts = np.frombuffer(starts, np.int64)
        shared &= starts >= 0
        found_rows.append(np.frombuffer(rows, np.int64)[shared])
        found_starts.append(starts[shared])
    row, start = np.concatenate(found_rows), np.concatenate(found_starts)
    by = np.lexsort((start, row))
    row, start = row[by], start[by]
    first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else np.zeros(0, int)
    return pd.DataFrame({"row": row[first], "starts": np.split(start, first[1:]) if len(row) else []})


def near(df: DataFrame) -> DataFrame:
    """Broadcast if its rows stay within BROADCAST_ROWS."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``row, spans`` (start, end in bytes) of the documents of ``with_row`` that repeat ``LENGTH`` bytes of any document."""
    found = materialize(runs(docs), "runs")
    common = materialize(found.groupBy("gram").agg(F.count("*").alias("n"), F.max("twice").alias("twice")).where("n > 1 or twice").select("gram"), "grams")
    live = materialize(found.join(common, "gram", "left_semi"), "live")
    first = F.min(F.struct("row", "start", "windows")).alias("first")
    kinds = materialize(live.groupBy("gram", "digest").agg(F.count("*").alias("n"), F.max("twice").alias("twice"), first), "kinds")
    copied = kinds.where("n > 1").select("gram", "digest")
    whole = live.join(copied, ["gram", "digest"], "left_semi").select("row", F.col("start").cast("long").alias("start"), (F.col("start") + F.col("windows") + (LENGTH - 1)).cast("long").alias("end"))
    # Open runs, each once and with every other kind of run around the same gram.
    open_ = F.col("n") == 1
    grams = kinds.groupBy("gram").agg(F.count("*").alias("kinds"), F.max(open_).alias("any_open"), F.max(open_ & F.col("twice")).alias("self")).where("any_open and (kinds > 1 or self)").select("gram", "kinds")
    parts = materialize(kinds.join(grams, "gram").select("gram", "digest", "kinds", open_.alias("open"), "first.*"), "open_runs")
    held = docs.select("row", F.col("text").cast("binary").alias("bytes"))
    cut = F.substring(F.col("bytes"), F.col("start") + 1, F.col("windows") + (LENGTH - 1))
    cut = held.join(near(parts), "row").select("gram", "digest", "kinds", "open", "row", "start", cut.alias("bytes"))
    pieces = materialize(cut.dropDuplicates(["gram", "digest"]), "pieces")
    size = pieces.agg(F.sum(F.length("bytes"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    split = F.col("kinds") > SHARD_RUNS
    salt = F.when(split, F.pmod(F.col("digest"), F.ceil(F.col("kinds") / SHARD_RUNS))).otherwise(F.lit(0).cast("long"))
    dealt = pieces.withColumn("split", split).withColumn("shard", F.pmod(F.xxhash64("gram", salt), F.lit(shards))).select("shard", "row", "start", "open", "split", "bytes")
    n_split = pieces.where(split).agg(F.sum(F.length("bytes") - (LENGTH - 1))).first()[0] or 0
    ranges = max(1, -(-n_split // RANGE_WINDOWS))
    local = materialize(dealt.groupBy("shard").applyInPandas(lambda x: shard_repeats(x, ranges), RESULT), "local")
    across = local.where("part is not null").groupBy("part").applyInPandas(merge_shards, "row long, starts array<long>")
    span = lambda start, end: F.struct(start.alias("start"), end.alias("end"))
    found = across.select("row", F.transform("starts", lambda x: span(x, x + LENGTH)).alias("some"))
    spans = whole.unionAll(local.where("part is null").select("row", "start", "end")).select("row", F.array(span(F.col("start"), F.col("end"))).alias("some")).unionAll(found)
    return spans.groupBy("row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("some")))).alias("spans"))


def kept_bytes(data: bytes, spans: list[dict] | None) -> tuple[int, int, bytes]:
    """(bytes removed, maximal removed runs, remaining bytes) for spans sorted by start."""
    removed, count, at, out = 0, 0, 0, []
    for s in spans or ():
        if s["start"] > at or not count:
            out.append(data[at : s["start"]])
            count += 1
            at = s["start"]
        if s["end"] > at:
            removed += s["end"] - at
            at = s["end"]
    out.append(data[at:])
    return removed, count, b"".join(out)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_bytes: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept``, the remaining bytes).

    Texts are UTF-8 bytes, null is empty; each byte goes that lies in a
    LENGTH-byte string which also starts elsewhere in any row's text, the same
    row included. Shorter texts lose nothing. Equal rows are documents of
    their own, so all their windows repeat.
    """
    docs = with_row(df, id_col, text_col)
    spans = materialize(repeated_spans(docs), "spans")

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, at in zip(batch.column("text"), batch.column("spans"), strict=True):
                data = text.as_py().encode("utf-8", "surrogatepass")
                removed, count, left = kept_bytes(data, at.as_py())
                out.append((len(data), removed, count, hashlib.sha256(left).hexdigest(), left))
            columns = [*zip(*out, strict=True)] or [[]] * 5
            arrays = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(columns[4], pa.binary())] * with_bytes, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_bytes)

    # Spans grow with the texts: both are dealt by row at every size, so that a small table's disk tells of a large one's.
    return docs.join(spans.hint("merge"), "row", "left").select("doc_id", "text", "spans").mapInArrow(strip, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_bytes)
