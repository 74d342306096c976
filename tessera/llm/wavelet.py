"""Token-id shards as wavelet matrices: bit-planes with rank and select in one compressed blob.

A plane holds one bit of every id; below it the ids stand stably parted by
that bit. Access, counting and occurrence lookup take one rank or select a
plane. A plane is stored in frames, compressed one by one, each with the ranks
of its blocks; a lookup opens one frame a plane and no other. A shard covers
consecutive documents and is one row of a written table, as executors share no
local files.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .encoding import encoder
from .storage import materialize, text_or_empty

MAGIC = b"WVM2"
#: 64-bit words between two stored ranks, and in a frame.
BLOCK, FRAME = 8, 8192


class WaveletMatrix:
    """Planes from the highest bit down; ``zeros[k]`` ids have a 0 in plane k. ``frames[k]`` are compressed, ``before[k]`` are the ones before each."""

    def __init__(self, frames: list[list[bytes]], before: list[list[int]], zeros: list[int], length: int):
        self.frames, self.before, self.zeros, self.length = frames, before, zeros, length
        self._open: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        width = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        at = ids.astype(np.uint16 if width <= 16 else np.uint32)
        frames, before, zeros, compress = [], [], [], zstandard.ZstdCompressor(level=1).compress
        n_words = -(-len(ids) // (64 * BLOCK)) * BLOCK
        for bit in range(width - 1, -1, -1):
            ones = (at >> bit) & 1 == 1
            words = np.zeros(8 * n_words, dtype=np.uint8)
            words[: -(-len(ids) // 8)] = np.packbits(ones, bitorder="little")
            words = words.view("<u8")
            sums = np.bitwise_count(words).reshape(-1, BLOCK).sum(1, dtype=np.uint32)
            ranks = (np.cumsum(sums, dtype=np.uint32) - sums).astype("<u4")
            cuts = range(0, n_words, FRAME)
            frames.append([compress(ranks[c // BLOCK : (c + FRAME) // BLOCK].tobytes() + words[c : c + FRAME].tobytes()) for c in cuts])
            before.append([int(ranks[c // BLOCK]) for c in cuts])
            low = at[~ones]
            zeros.append(len(low))
            at = np.concatenate((low, at[ones]))
        return cls(frames, before, zeros, len(ids))

    def _frame(self, k: int, c: int) -> tuple[np.ndarray, np.ndarray]:
        """(ranks, words) of frame c of plane k."""
        if (k, c) not in self._open:
            raw = zstandard.ZstdDecompressor().decompress(self.frames[k][c])
            cut = 4 * (len(raw) // (4 + 8 * BLOCK))
            self._open[k, c] = np.frombuffer(raw[:cut], "<u4"), np.frombuffer(raw[cut:], "<u8")
        return self._open[k, c]

    def _rank1(self, k: int, i: int) -> int:
        """Ones before position i of plane k."""
        if i >= self.length:
            return self.length - self.zeros[k]
        c, word = divmod(i // 64, FRAME)
        ranks, words = self._frame(k, c)
        block = word // BLOCK
        whole = np.bitwise_count(words[block * BLOCK : word]).sum(dtype=np.int64)
        return int(ranks[block]) + int(whole) + (int(words[word]) & ((1 << (i % 64)) - 1)).bit_count()

    def _select(self, k: int, bit: int, nth: int) -> int:
        """Position of the nth (from 0) ``bit`` of plane k: the frame, then the block by stored ranks, then the bit in it."""
        step = 64 * BLOCK
        firsts = [n if bit else c * FRAME * 64 - n for c, n in enumerate(self.before[k])]
        c = bisect_right(firsts, nth) - 1
        ranks, words = self._frame(k, c)
        ranks = ranks.astype(np.int64)
        if not bit:
            ranks = (c * FRAME * 64 + np.arange(len(ranks)) * step) - ranks
        block = int(np.searchsorted(ranks, nth, "right")) - 1
        bits = np.unpackbits(words[block * BLOCK : (block + 1) * BLOCK].view(np.uint8), bitorder="little")
        return c * FRAME * 64 + block * step + int(np.flatnonzero(bits == bit)[nth - int(ranks[block])])

    def _bit(self, k: int, i: int) -> int:
        c, word = divmod(i // 64, FRAME)
        return (int(self._frame(k, c)[1][word]) >> (i % 64)) & 1

    def access(self, i: int) -> int:
        value = 0
        for k, zero in enumerate(self.zeros):
            ones, bit = self._rank1(k, i), self._bit(k, i)
            value = 2 * value + bit
            i = zero + ones if bit else i - ones
        return value

    def extract(self, start: int, end: int) -> np.ndarray:
        """The ids of positions start..end, by one vectorised rank a plane."""
        at = np.arange(start, end, dtype=np.int64)
        value = np.zeros(len(at), dtype=np.uint32)
        for k, zero in enumerate(self.zeros):
            if not len(at):
                break
            parts = [self._frame(k, c) for c in range(len(self.frames[k]))]
            ranks, words = (np.concatenate(p) for p in zip(*parts, strict=True))
            inside = np.bitwise_count(words).reshape(-1, BLOCK)
            of_word = (np.cumsum(inside, axis=1, dtype=np.uint32) - inside + ranks[:, None]).ravel()
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            bits = words[word]
            ones = of_word[word] + np.bitwise_count(bits & ((np.uint64(1) << shift) - np.uint64(1)))
            bit = ((bits >> shift) & np.uint64(1)).astype(bool)
            at = np.where(bit, zero + ones.astype(np.int64), at - ones)
            value = (value << np.uint32(1)) | bit
        return value

    def whole(self) -> np.ndarray:
        """All ids: the planes undone from the lowest up, each parting put back by its bits, without a rank."""
        value = np.zeros(self.length, dtype=np.uint16 if len(self.zeros) <= 16 else np.uint32)
        for k in range(len(self.zeros) - 1, -1, -1):
            words = np.concatenate([self._frame(k, c)[1] for c in range(len(self.frames[k]))]) if self.frames[k] else np.zeros(0, "<u8")
            ones = np.unpackbits(words.view(np.uint8), count=self.length, bitorder="little").view(bool)
            above = np.empty_like(value)
            above[~ones] = value[: self.zeros[k]]
            above[ones] = value[self.zeros[k] :] | value.dtype.type(1 << (len(self.zeros) - 1 - k))
            value = above
            for c in range(len(self.frames[k])):
                self._open.pop((k, c), None)
        return value

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        for k, zero in enumerate(self.zeros):
            a, b = self._rank1(k, start), self._rank1(k, end)
            start, end = (zero + a, zero + b) if (token >> (len(self.zeros) - 1 - k)) & 1 else (start - a, end - b)
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """How often ``token`` stands in start..end."""
        if token >> len(self.zeros) or not self.length:
            return 0
        a, b = self._range(token, start, self.length if end is None else end)
        return b - a

    def locate(self, token: int, nth: int) -> int:
        """Position of the nth (from 0) occurrence of ``token``, or -1."""
        if nth >= self.count(token):
            return -1
        i = self._range(token, 0, self.length)[0] + nth
        for k in range(len(self.zeros) - 1, -1, -1):
            bit = (token >> (len(self.zeros) - 1 - k)) & 1
            i = self._select(k, bit, i - self.zeros[k] if bit else i)
        return i

    def to_bytes(self, doc_ids: list[int | None], lengths: list[int]) -> bytes:
        """Magic, length of the head, the head (compressed) with each frame's size, the frames."""
        sizes = [[len(f) for f in plane] for plane in self.frames]
        head = {"zeros": self.zeros, "length": self.length, "before": self.before, "sizes": sizes, "docs": doc_ids, "lengths": lengths}
        head = zstandard.ZstdCompressor(level=1).compress(json.dumps(head).encode())
        return MAGIC + len(head).to_bytes(8, "little") + head + b"".join(f for plane in self.frames for f in plane)

    @classmethod
    def from_bytes(cls, blob: bytes) -> tuple[WaveletMatrix, list[int | None], list[int]]:
        """The matrix, no frame of it opened yet, and its documents with their lengths."""
        if blob[:4] != MAGIC:
            raise ValueError("not a wavelet shard")
        at = 12 + int.from_bytes(blob[4:12], "little")
        head = json.loads(zstandard.ZstdDecompressor().decompress(blob[12:at]))
        frames: list[list[bytes]] = []
        for plane in head["sizes"]:
            frames.append([])
            for size in plane:
                frames[-1].append(blob[at : at + size])
                at += size
        return cls(frames, head["before"], head["zeros"], head["length"]), head["docs"], head["lengths"]


def write_shards(df: DataFrame, tokenizer_path: str, end_id: int = 2, shard_tokens: int = 2_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes whole texts in ascending id order and writes ``part, seq, n_tokens, shard`` (the blob), read back from the shared folder.

    Ranges of ids are dealt to tasks; task ``part`` closes its shard ``seq``
    at ``shard_tokens`` ids, at a document's end, so one very long document is
    a shard of its own. Null and empty texts are their end id alone; documents
    with equal ids stand next to each other, by text, null ids first. No rows
    give no shard. Only the two named columns are read.
    """
    end = end_id.to_bytes(4, "little")

    def encode_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, False).encode
        docs, lengths, parts, held, seq = [], [], [], 0, 0
        part = TaskContext.get().partitionId()

        def shard() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), dtype="<u4")
            blob = WaveletMatrix.build(ids).to_bytes(docs, lengths)
            return pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in (part, seq, len(ids))), pa.array([blob], pa.binary())], names=["part", "seq", "n_tokens", "shard"])

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = encode(text.as_py()) + end
                docs.append(doc)
                lengths.append(len(ids) // 4)
                parts.append(ids)
                held += len(ids) // 4
                if held >= shard_tokens:
                    yield shard()
                    docs, lengths, parts, held, seq = [], [], [], 0, seq + 1
        if docs:
            yield shard()

    ordered = text_or_empty(df, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return materialize(ordered.mapInArrow(encode_all, "part long, seq long, n_tokens long, shard binary"), "wavelet")


def read_shards(shards: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, read back from the shards; ``start`` counts all ids before it."""
    # One small row a shard is all that the running total sees: 500,000 rows for 10**12 ids.
    before = W.orderBy("of_part", "of_seq").rowsBetween(W.unboundedPreceding, -1)
    starts = shards.select(F.col("part").alias("of_part"), F.col("seq").alias("of_seq"), "n_tokens").select("of_part", "of_seq", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("shard_start"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob, start in zip(batch.column("shard").to_pylist(), batch.column("shard_start").to_pylist(), strict=True):
                matrix, docs, lengths = WaveletMatrix.from_bytes(blob)
                ids = matrix.whole().astype("<u4")
                ends = np.cumsum(lengths)
                begins = ends - lengths
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begins, ends, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(begins + start, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    keyed = shards.join(starts, (F.col("part") == F.col("of_part")) & (F.col("seq") == F.col("of_seq"))).select("shard", "shard_start")
    return keyed.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")
