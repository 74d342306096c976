"""Packing token sequences: first-fit decreasing over a tournament tree, in randomised groups.

Documents are cut at multiples of the sequence length, so only each one's last
piece is shorter. Pieces are dealt by hash into groups of a fixed mean size;
a group is packed alone, so the work is one shuffle of small rows, no group
grows with the input, and a lost task repacks its groups to the same result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .encoding import encoder
from .storage import materialize, text_or_empty


class BinTree:
    """Tournament tree over the free space of ``size`` bins: a parent holds the larger of its two children."""

    def __init__(self, size: int, capacity: int):
        self.leaves = 1 << max(0, size - 1).bit_length()
        self.free = [capacity] * (2 * self.leaves)

    def first_fit(self, length: int) -> tuple[int, int]:
        """Puts ``length`` into the leftmost bin with room: (bin, offset in it)."""
        free, node = self.free, 1
        while node < self.leaves:
            node *= 2
            if free[node] < length:
                node += 1
        room = free[node]
        free[node] = room - length
        place = node - self.leaves
        while node > 1:
            node //= 2
            free[node] = max(free[2 * node], free[2 * node + 1])
        return place, room


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each length; equal lengths keep their order."""
    tree = BinTree(len(lengths), capacity)
    out = [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        place, room = tree.first_fit(lengths[i])
        out[i] = (place, capacity - room)
    return out


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def token_pieces(df: DataFrame, tokenizer_path: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Each document's ids and its end id, cut at multiples of ``capacity``; ``with_ids`` adds them as little-endian uint32 ``ids``."""
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, True).encode
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = encode(text.as_py()) + end
                n = len(ids) // 4
                for start in range(0, n, capacity):
                    part = ids[4 * start : 4 * (start + capacity)]
                    rows.append((doc, start, len(part) // 4, zlib.crc32(part), n, part))
            columns = [*zip(*rows, strict=True)] or [[]] * 6
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            arrays = [pa.array(c, pa.int64()) for c in columns[:5]]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(columns[5], pa.binary())] * with_ids, names=names + ["ids"] * with_ids)

    return text_or_empty(df, id_col, text_col).mapInArrow(cut, PIECES + ", ids binary" * with_ids)


def pack(pieces: DataFrame, capacity: int, group_size: int = 2000, seed: int = 7) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with ``doc_id, start, length``: no sequence exceeds ``capacity``, offsets are gapless from 0.

    ``pieces`` is a written table, so a row's number in it, which takes part
    in the hash, is the same when a task runs again: null or repeated ids are
    dealt as evenly as others. No rows give no rows; equal rows each get a
    place of their own. ``length`` must be 1 to ``capacity``.
    """
    n_groups = max(1, -(-pieces.count() // group_size))
    schema = StructType([*pieces.schema, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    grouped = pieces.withColumn("pack_group", F.pmod(F.xxhash64("doc_id", "start", F.monotonically_increasing_id(), F.lit(seed)), F.lit(n_groups)))

    def place(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "start"], kind="stable").drop(columns="pack_group")
        places = first_fit_decreasing(rows["length"].tolist(), capacity)
        return rows.assign(sequence_id=[(int(key[0]) << 32) + b for b, _ in places], offset=[o for _, o in places])

    return grouped.groupBy("pack_group").applyInPandas(place, schema)


def pack_documents(df: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Whole documents to packed pieces: PIECES, ``sequence_id``, ``offset`` (and ``ids``). Null and empty texts are their end id alone; one very long text is one task's work, its pieces are not. Other columns are not read."""
    return pack(materialize(token_pieces(df, tokenizer_path, end_id, capacity, id_col, text_col, with_ids), "pieces"), capacity)
