"""Near-duplicate documents by Order MinHash, verified by banded alignment.

A sketch entry samples the few smallest of a document's occurrence-labelled
five-word shingles under one hash order and keeps them in text order, so
documents agree on it only if they share those shingles in that order. Each
entry is a bucket of its own. Documents that share a bucket are aligned: the
longest common chain of shingles within the band that the similarity allows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkeys as K
from .components import components
from .neardup import Content, near_links, shared_buckets
from .storage import materialize, text_or_empty
from .workers import trim

WORDS = 5
SIMILARITY = 0.8
ENTRIES = 32
TAKEN = 3
_ODD = np.random.default_rng(5).integers(1, 2**63, ENTRIES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sketch(keys: np.ndarray) -> np.ndarray:
    """The bucket of each sketch entry; a text of few shingles has one bucket, all of them."""
    if len(keys) <= TAKEN:
        chosen = keys[None]
    else:
        # A few entries at a time: the products of a very long text with all of them would be many times its size.
        some = max(1, (1 << 20) // len(keys))
        place = np.concatenate([np.argpartition(keys[None] * _ODD[i : i + some, None], TAKEN - 1, axis=1)[:, :TAKEN] for i in range(0, ENTRIES, some)])
        place.sort(axis=1)
        chosen = keys[place]
    bucket = np.arange(len(chosen), dtype=np.uint64)
    for k in range(chosen.shape[1]):
        bucket = K.mix(bucket * K.U64(0x9E3779B97F4A7C15) + chosen[:, k])
    return bucket.view(np.int64)


def shingled(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word keys with their bounds, and occurrence-labelled shingle keys with theirs."""
    data = K.lower_ascii(data)
    starts, ends, words_at = K.word_bounds(data, offsets)
    words = K.span_keys(*K.prefix_keys(data), starts, ends)
    keys, at = K.shingle_keys(words, words_at, WORDS)
    return words, words_at, K.occurrence_labelled(keys, at), at


def chain(p: np.ndarray) -> int:
    """Length of the longest increasing chain."""
    if len(p) < 2 or (p[1:] > p[:-1]).all():
        return len(p)
    tails: list[int] = []
    for v in p.tolist():
        at = bisect_left(tails, v)
        if at == len(tails):
            tails.append(v)
        else:
            tails[at] = v
    return len(tails)


def aligned_similarity(x: np.ndarray, y: np.ndarray, floor: float = SIMILARITY) -> float:
    """Shingles in the best alignment over those of both texts; 0.0 where it can't reach ``floor``.

    An alignment of enough shingles can't stray from the diagonal by more than
    the shingles it may leave out: matches outside that band are dropped.
    """
    need = int(np.ceil(floor * (len(x) + len(y)) / (1 + floor) - 1e-9))
    if not need or min(len(x), len(y)) < need:
        return 0.0
    order = np.argsort(y)
    at = np.minimum(np.searchsorted(y[order], x), len(y) - 1)
    met = np.flatnonzero(y[order][at] == x)
    to = order[at[met]]
    inside = np.abs(met - to) <= max(len(x), len(y)) - need
    length = chain(to[inside]) if inside.sum() >= need else 0
    return length / (len(x) + len(y) - length) if length >= need else 0.0


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, n`` (shingles), ``same`` (digest of the words, null without words) and ``buckets``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in K.pieces(batch, "text"):
                words, words_at, keys, at = shingled(data, offsets)
                same = [hashlib.blake2b(words[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(words_at[:-1], words_at[1:], strict=True)]
                buckets = [sketch(keys[a:b]) if b > a else np.zeros(0, np.int64) for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(at)), pa.array(same, pa.binary()), pa.array(buckets, pa.list_(pa.int64()))], names=["doc_id", "n", "same", "buckets"])
        trim()

    return docs.mapInArrow(run, "doc_id long, n long, same binary, buckets array<long>")


def shingle_lists(texts: list[str]) -> list[np.ndarray]:
    """The occurrence-labelled shingle keys of each text, in text order."""
    out: list[np.ndarray] = []
    for _, data, offsets in K.pieces(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"]), "text"):
        _, _, keys, at = shingled(data, offsets)
        out += [keys[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
    return out


def aligned(x: np.ndarray, y: np.ndarray) -> bool:
    return aligned_similarity(x, y) >= SIMILARITY


def content_of(docs: DataFrame, live: DataFrame) -> Content:
    """The texts in question, gathered once, and how they are compared. A leader of many pairs is a skewed key of the join with its text, which adaptive execution splits."""
    held = docs.join(live.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    texts = materialize(held.select(F.col("doc_id").alias("id"), "text"), "texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, np.ndarray] = {}

        def keys_of(text: str) -> np.ndarray:
            if text not in kept:
                if len(kept) > 64:
                    kept.clear()
                kept[text] = shingle_lists([text])[0]
            return kept[text]

        for batch in batches:
            pairs = zip(batch.column("x"), batch.column("y"), strict=True)
            good = [aligned(keys_of(x.as_py()), keys_of(y.as_py())) for x, y in pairs]
            yield batch.select(["ra", "rb"]).filter(pa.array(good, pa.bool_()))

    def verify(pairs: DataFrame) -> DataFrame:
        x = texts.select(F.col("id").alias("a"), F.col("text").alias("x"))
        y = texts.select(F.col("id").alias("b"), F.col("text").alias("y"))
        return pairs.join(y, "b").join(x, "a").select("ra", "rb", "x", "y").mapInArrow(run, "ra long, rb long")

    return Content(texts, shingle_lists, aligned, verify, True)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, rep_id`` (smallest id with the same words), ``class_id`` (smallest id of the group), ``keep``.

    Groups are the connected components of "same words" and of an aligned
    similarity of five-word shingles of at least 0.8; a text of one to four
    words is one shingle. Null, empty and wordless texts are each alone. Rows
    with equal ids are one document. A null id keeps a null class and is kept.
    """
    docs = text_or_empty(df, id_col, text_col)
    known = materialize(sketches(docs), "sketches")
    usable = known.where("same is not null and doc_id is not null")
    reps = usable.groupBy("same").agg(F.min("doc_id").alias("rep_id"))
    member = materialize(usable.select("doc_id", "same").join(reps, "same").select("doc_id", "rep_id"), "member")
    alone = known.join(member.select(F.col("rep_id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    live = shared_buckets(alone.select(F.explode("buckets").alias("bucket"), F.col("doc_id").alias("id"), "n"))
    entries = alone.select(F.col("doc_id").alias("id"), F.col("buckets").alias("entries"))
    near = near_links(live, entries, SIMILARITY, content_of(docs, live), 8)
    # A document that stands twice with different texts ties its representatives together.
    ties = member.groupBy("doc_id").agg(F.min("rep_id").alias("a"), F.max("rep_id").alias("b")).where("a <> b").select(F.col("a").alias("id"), F.col("b").alias("root"))
    if not ties.isEmpty():
        near = components(near.unionAll(ties).select(F.col("id").alias("a"), F.col("root").alias("b")))
    rep = member.groupBy("doc_id").agg(F.min("rep_id").alias("rep_id"))
    classed = rep.join(near.select(F.col("id").alias("rep_id"), "root"), "rep_id", "left").select("doc_id", "rep_id", F.coalesce("root", "rep_id").alias("class_id"))
    out = known.select("doc_id").join(classed, "doc_id", "left")
    return out.select("doc_id", F.coalesce("rep_id", "doc_id").alias("rep_id"), F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce(F.col("class_id") == F.col("doc_id"), F.lit(True)).alias("keep"))
