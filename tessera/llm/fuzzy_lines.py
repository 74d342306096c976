"""Fuzzy line dedup by MinHash over character shingles.

A line's signature is a one-permutation MinHash: a shingle's hash chooses a bin
and each bin keeps its minimum; bands of bins are buckets. Lines that share a bucket are compared by the exact Jaccard
similarity of their shingle sets (up to 64-bit keys), similar ones are joined by a distributed
union-find, and each component keeps its first line.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import encoding
from . import textkeys as K
from .neardup import Content, near_links, shared_buckets
from .storage import materialize
from .workers import trim

CHARS = 8
SIMILARITY = 0.8
#: A signature is HASHES one-permutation sketches of BINS minima each, cut into bands of ROWS.
HASHES, BINS, ROWS = 2, 12, 3
BANDS = HASHES * BINS // ROWS
#: The default of the least length of a line; the query and the pipeline take every line that isn't blank.
MIN_CHARS = 40
#: What stands at a line's ends without being part of it; ASCII letters count in lower case.
EDGE = " \t\r\x0b\x0c"
#: Bytes or characters of text whose shingles are hashed at once: arrays of this size stay in a core's cache.
PIECE = 1 << 17
#: Bits of the filter of wanted lines, per line and at most (32 MB): one in 16 to 33 other lines passes it below that.
BITS, MOST_BITS = 16, 1 << 28
_RANDOM = np.random.default_rng(9)
_CHAR = _RANDOM.integers(0, 2**31, CHARS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_CHAR64 = _RANDOM.integers(0, 2**63, CHARS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TIMES = _RANDOM.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_NONE = np.uint32(0xFFFFFFFF)


def lower_ascii(text: str) -> str:
    """A-Z in lower case, other letters as they are."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def line_id(line: str) -> int:
    return int.from_bytes(hashlib.blake2b(line.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def shingle_hashes(points: np.ndarray) -> np.ndarray:
    """32-bit hashes of the CHARS code points from each place on."""
    n = len(points) - CHARS + 1
    h, t = np.zeros(n, dtype=np.uint32), np.empty(n, dtype=np.uint32)
    for k in range(CHARS):
        h += np.multiply(points[k : k + n], _CHAR[k], out=t)
        h ^= np.right_shift(h, np.uint32(15), out=t)
    h *= np.uint32(0x2C1B3C6D)
    return h ^ (h >> np.uint32(12))


def densified(low: np.ndarray) -> np.ndarray:
    """Empty bins take the next filled one to the right, around the end, moved by how far it is."""
    n, bins = low.shape
    twice = np.concatenate((low, low), axis=1)
    place = np.where(twice != _NONE, np.arange(2 * bins, dtype=np.int32), np.int32(2 * bins))
    next_ = np.minimum.accumulate(place[:, ::-1], axis=1)[:, ::-1][:, :bins]
    far = (next_ - np.arange(bins, dtype=np.int32)).astype(np.uint32)
    return np.take_along_axis(twice, next_.astype(np.int64), axis=1) + far * np.uint32(0x9E3779B1)


def band_keys(lines: list[str]) -> np.ndarray:
    """One row of BANDS 32-bit keys for each line of at least CHARS code points."""
    sizes = np.array([len(x) for x in lines], dtype=np.int64)
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    h = shingle_hashes(points)
    row = np.repeat(np.arange(len(lines), dtype=np.int64) * BINS, sizes)[: len(h)]
    ends = np.cumsum(sizes)
    across = (ends[:-1, None] - np.arange(1, CHARS)).ravel()  # shingles that run into the next line
    row[across[across < len(h)]] = len(lines) * BINS
    out, v, t, bin_ = [], np.empty_like(h), np.empty_like(h), np.empty_like(row)
    for times in _TIMES:
        np.multiply(h, times, out=v)
        v ^= np.right_shift(v, np.uint32(15), out=t)
        v *= np.uint32(0x297A2D39)
        v ^= np.right_shift(v, np.uint32(15), out=t)
        np.right_shift(v, np.uint32(16), out=t)
        t *= np.uint32(BINS)
        t >>= np.uint32(16)
        np.add(row, t, out=bin_)
        v *= np.uint32(0x85EBCA6B)
        v >>= np.uint32(1)
        low = np.full((len(lines) + 1) * BINS, _NONE, dtype=np.uint32)
        np.minimum.at(low, bin_, v)
        out.append(densified(low[: len(lines) * BINS].reshape(-1, BINS)))
    bands = np.concatenate(out, axis=1).reshape(len(lines), BANDS, ROWS).astype(np.uint64)
    key = np.zeros((len(lines), BANDS), dtype=np.uint64)
    for k in range(ROWS):
        key = K.mix(key + bands[:, :, k] + K.U64(1))
    return (key >> K.U64(32)).astype(np.uint32).view(np.int32)


def shingle_set(line: str) -> set[str]:
    return {line[i : i + CHARS] for i in range(len(line) - CHARS + 1)}


def distinct(keys: np.ndarray) -> np.ndarray:
    """The different values, sorted."""
    keys = np.sort(keys)
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    return keys[new]


def shingle_tokens(lines: list[str]) -> list[np.ndarray]:
    """64-bit keys of each line's distinct shingles, sorted; lines are hashed PIECE characters at a time."""
    out: list[np.ndarray] = []
    some, size = [], 0
    for line in lines:
        some.append(lower_ascii(line).strip(EDGE))
        size += len(line)
        if size >= PIECE:
            out += _tokens_of(some)
            some, size = [], 0
    return out + _tokens_of(some)


def _tokens_of(lines: list[str]) -> list[np.ndarray]:
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    h = np.zeros(max(len(points) - CHARS + 1, 0), dtype=np.uint64)
    t = np.empty_like(h)
    for k in range(CHARS if len(h) else 0):
        h += np.multiply(points[k : k + len(h)], _CHAR64[k], out=t)
    h = K.mix(h)
    ends = np.cumsum([len(x) for x in lines])
    return [distinct(h[b - len(x) : max(b - CHARS + 1, b - len(x))]) for x, b in zip(lines, ends.tolist(), strict=True)]


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets have a Jaccard similarity of at least SIMILARITY; sets too different in size aren't compared."""
    if min(len(a), len(b)) < SIMILARITY * max(len(a), len(b)):
        return False
    both = np.concatenate((a, b))
    both.sort()
    shared = np.count_nonzero(both[1:] == both[:-1])
    return shared / (len(both) - shared) >= SIMILARITY


def similar_pairs(xs: list[str], ys: list[str]) -> Iterator[bool]:
    """``similar`` of each two lines, whose shingles are hashed once for each run of pairs of about a million characters."""
    ends = np.cumsum([len(x) + len(y) for x, y in zip(xs, ys, strict=True)])
    at = 0
    while at < len(xs):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 8 * PIECE, "right")))
        lines = list(dict.fromkeys(xs[at:to] + ys[at:to]))
        sets = dict(zip(lines, shingle_tokens(lines), strict=True))
        yield from (similar(sets[x], sets[y]) for x, y in zip(xs[at:to], ys[at:to], strict=True))
        at = to


def with_row(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text, row``; ``row`` names the document by id and text, so equal rows share it."""
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return docs.withColumn("row", F.xxhash64("doc_id", "text"))


def line_bands(docs: DataFrame, least: int) -> DataFrame:
    """``doc_id, row, line_no, id, n, bands`` for each line of at least ``least`` characters, edges aside; ``id`` is a digest of the line.

    A line shorter than a shingle has no bands, so it meets its equals only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding.release()
        for batch in batches:
            for part, _, _ in K.pieces(batch, "text", PIECE):
                places, lines = [], []
                for i, text in enumerate(part.column("text").to_pylist()):
                    for no, line in enumerate(lower_ascii(text).split("\n")):
                        if len(line := line.strip(EDGE)) >= least:
                            places.append((i, no))
                            lines.append(line)
                if not lines:
                    continue
                at, no = (np.array(x) for x in zip(*places, strict=True))
                rows = part.select(["doc_id", "row"]).take(pa.array(at))
                shingled = [x for x in lines if len(x) >= CHARS]
                keys = band_keys(shingled).ravel() if shingled else np.zeros(0, dtype=np.int32)
                ends = np.cumsum([0] + [BANDS if len(x) >= CHARS else 0 for x in lines])
                bands = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(no, pa.int32()), pa.array([line_id(x) for x in lines], pa.int64()), pa.array([max(len(x) - CHARS + 1, 0) for x in lines], pa.int32()), bands], names=["doc_id", "row", "line_no", "id", "n", "bands"])
        trim()

    return docs.mapInArrow(run, "doc_id long, row long, line_no int, id long, n int, bands array<int>")


def among(rows: DataFrame, wanted: DataFrame, *key: str) -> DataFrame:
    """The ``rows`` whose ``key`` is one of the materialized ``wanted``, and few others: those that share a bit of a filter with one."""
    bits = min(MOST_BITS, 1 << max(15, (BITS * wanted.count() - 1).bit_length()))
    at = F.xxhash64(*key).bitwiseAND(F.lit(bits - 1)) + 1
    chunk, bit = F.bitmap_bucket_number(at).alias("chunk"), F.bitmap_bit_position(at).alias("bit")
    filter_ = wanted.select(chunk, bit).repartition("chunk").groupBy("chunk").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    byte = F.conv(F.hex(F.substring("bitmap", (F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.call_function("shiftright", byte, (F.col("bit") % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    return rows.select("*", chunk, bit).join(F.broadcast(filter_), "chunk").where(is_set).select(*rows.columns)


def content_of(docs: DataFrame, lines: DataFrame, live: DataFrame) -> Content:
    """The lines in question, gathered once, and how they are compared, by Jaccard similarity of their sets of 64-bit shingle keys."""
    wanted = live.select("id").distinct()
    first = lines.join(wanted, "id").groupBy("id").agg(F.min(F.struct("row", "line_no")).alias("p"))
    first = materialize(first.select("id", F.col("p.row").alias("row"), F.col("p.line_no").alias("line_no")), "firsts")
    # A filter of places, sent to all, keeps other lines from being dealt; the join is exact.
    some = among(docs.select("row", F.posexplode(F.split("text", "\n")).alias("line_no", "line")), first, "row", "line_no")
    texts = materialize(some.join(first, ["row", "line_no"]).dropDuplicates(["row", "line_no"]).select("id", "line"), "lines")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = similar_pairs(batch.column("x").to_pylist(), batch.column("y").to_pylist())
            yield batch.select(["ra", "rb"]).filter(pa.array(good, pa.bool_()))
        trim()

    def verify(pairs: DataFrame) -> DataFrame:
        x = texts.select(F.col("id").alias("a"), F.col("line").alias("x"))
        y = texts.select(F.col("id").alias("b"), F.col("line").alias("y"))
        return pairs.join(y, "b").join(x, "a").select("ra", "rb", "x", "y").mapInArrow(run, "ra long, rb long")

    return Content(texts.withColumnRenamed("line", "text"), shingle_tokens, None, verify, False)


def different_lines(lines: DataFrame) -> DataFrame:
    """``id, n, entries`` (buckets) of each different line that has bands. Equal lines have equal bands, so maxima of two bands in a long each are theirs."""
    pair = lambda k: F.shiftleft(F.col("bands")[2 * k].cast("long"), 32).bitwiseOR(F.col("bands")[2 * k + 1].cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    once = lines.where(F.size("bands") > 0).groupBy("id").agg(F.max("n").cast("long").alias("n"), *(F.max(pair(k)).alias(f"p{k}") for k in range(BANDS // 2)))
    once = materialize(once, "different")
    keys = [F.shiftright(x, 32) for k in range(BANDS // 2) for x in (F.col(f"p{k}"), F.shiftleft(f"p{k}", 32))]
    return once.select("id", "n", F.array(*(F.shiftleft(key, 4).bitwiseOR(F.lit(band).cast("long")) for band, key in enumerate(keys))).alias("entries"))


def shared_entries(live: DataFrame) -> DataFrame:
    """``id, entries``: the ``live`` buckets of each line by band; for one that no other line is in stands ``id``, which is no other line's."""
    held = [F.coalesce(F.max(F.when(F.col("bucket").bitwiseAND(F.lit(15)) == band, F.col("bucket"))), F.col("id")) for band in range(BANDS)]
    return live.groupBy("id").agg(F.array(*held).alias("entries"))


def repeated_lines(docs: DataFrame, least: int) -> DataFrame:
    """``row, removed`` (sorted line numbers from 0) of the documents of ``with_row`` that lose a line."""
    lines = materialize(line_bands(docs, least), "signatures")
    different = different_lines(lines)
    live = shared_buckets(different.select(F.explode("entries").alias("bucket"), "id", "n"), unique=True)
    near = near_links(live, shared_entries(live), SIMILARITY, content_of(docs, lines, live), 4)
    classed = lines.select("doc_id", "row", "line_no", "id").join(near, "id", "left").withColumn("class", F.coalesce("root", "id")).drop("root")
    place = F.struct("doc_id", "row", "line_no")
    # Most lines stand alone: a count sends them off before anything is sorted.
    several = classed.groupBy("class").count().where("count > 1").select("class")
    classed = materialize(classed.join(several, "class", "left_semi"), "classed")
    firsts = classed.groupBy("class").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").select("class", "first")
    lost = classed.join(firsts, "class").where(~place.eqNullSafe(F.col("first")))
    return lost.groupBy("row").agg(F.array_sort(F.collect_set("line_no")).alias("removed"))


def fuzzy_line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_CHARS) -> DataFrame:
    """One row per input row: ``doc_id, n_lines, n_removed, removed`` (line numbers from 0).

    A line goes if it is equal (ASCII case and white space at its ends aside)
    or of a character-shingle similarity of at least 0.8 to one that stays
    before it, by id and line number, through any chain of such lines; lines
    under ``least`` characters, and blank ones, stay; lines shorter than a
    shingle go if they are equal. Null and empty texts have one empty line. Rows with
    equal ids and texts are one document, each row giving the same result.
    """
    docs = with_row(df, id_col, text_col)
    counted = docs.select("doc_id", "row", (F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"))) + 1).cast("long").alias("n_lines"))
    out = counted.join(repeated_lines(docs, least), "row", "left").withColumn("removed", F.coalesce("removed", F.array().cast("array<int>")))
    return out.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")


def without_repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all its columns, with the removed lines taken out of ``text_col``.

    A row that loses lines and keeps none but blank ones goes: all it says
    stays elsewhere. Rows with equal ids and texts are one document and lose
    the same lines. A very long line is one row's work.
    """
    docs = with_row(df, id_col, text_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # The columns travel in one struct, so that their names can't clash with those used here.
    named = df.select(F.xxhash64(F.col(id_col).cast("long"), text).alias("row"), text.alias("text"), F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("kept"))
    both = named.join(repeated_lines(docs, 1), "row", "left")
    both = both.withColumn("left", F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains("removed", i)))
    bare = ~F.exists("left", lambda line: line.rlike(f"[^{EDGE}]"))
    both = both.where(F.col("removed").isNull() | ~bare)
    cut = F.when(F.col("removed").isNull(), F.col("kept")).otherwise(F.col("kept").withField(f"`{text_col}`", F.array_join("left", "\n")))
    return both.select(cut.alias("kept")).select("kept.*")
