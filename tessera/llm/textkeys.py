"""Vectorised word and character keys over Arrow text buffers.

A batch's texts stay in one byte buffer; words, shingles and windows are
numpy slices of it, so no Python object is made for a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_SEED = np.random.default_rng(20240607)
#: A random odd 64-bit value for each byte, and the base of the polynomial keys with its inverse mod 2**64.
BYTE_VALUE = _SEED.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def pieces(batch: pa.RecordBatch, column: str, max_bytes: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of rows of about ``max_bytes`` of text: (rows, bytes, offsets from 0). One long text stays whole."""
    text = batch.column(column)
    if pa.types.is_large_string(text.type):
        text = text.cast(pa.string())
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int32, count=len(text) + text.offset + 1)[text.offset :].astype(np.int64)
    data = np.frombuffer(text.buffers()[2] or b"", dtype=np.uint8)
    at = 0
    while at < len(text):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + max_bytes, "right")) - 1)
        to = min(to, len(text))
        yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words (runs of digits, letters and non-ASCII) and, per text, how many words precede it."""
    inside = ((data >= 48) & (data <= 57)) | ((data >= 97) & (data <= 122)) | ((data >= 65) & (data <= 90)) | (data >= 128)
    edge = np.zeros(len(data) + 1, dtype=bool)  # a word starts here though the byte before is inside one
    edge[offsets[:-1]] = True
    before = np.concatenate(([False], inside[:-1])) if len(data) else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate((inside[1:], [False])) if len(data) else inside
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def prefix_keys(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, inverse powers): the key of bytes s..e is (sums[e] - sums[s]) * inverse[s], the same wherever the bytes stand."""
    n = len(data)
    power = np.full(n + 1, BASE, dtype=np.uint64)
    inverse = np.full(n + 1, INVERSE, dtype=np.uint64)
    power[0] = inverse[0] = 1
    np.cumprod(power, out=power)
    np.cumprod(inverse, out=inverse)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUE[data] * power[:-1], out=sums[1:])
    return sums, inverse


def span_keys(sums: np.ndarray, inverse: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def shingle_keys(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of ``size`` consecutive words, texts one after another, and their bounds; a shorter text that has words is one shingle."""
    n_words = np.diff(bounds)
    count = np.where(n_words >= size, n_words - size + 1, (n_words > 0).astype(np.int64))
    to = np.concatenate(([0], np.cumsum(count)))
    owner = np.repeat(np.arange(len(n_words)), count)
    first = bounds[:-1][owner] + np.arange(to[-1]) - to[:-1][owner]
    size_here = np.minimum(n_words, size)[owner]
    keys = size_here.astype(np.uint64)
    for k in range(size):
        here = size_here > k
        keys = np.where(here, mix(keys + words[np.where(here, first + k, 0)]) if len(words) else keys, keys)
    return keys, to


def occurrence_labelled(keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each key mixed with how many equal keys stand before it in its text, which makes the keys of one text distinct."""
    owner = np.repeat(np.arange(len(bounds) - 1, dtype=np.uint64), np.diff(bounds))
    apart = mix(keys + owner * U64(0xA24BAED4963EE407))
    order = np.argsort(apart, kind="stable")
    by_key = apart[order]
    new = np.concatenate(([True], by_key[1:] != by_key[:-1])) if len(keys) else np.zeros(0, dtype=bool)
    at = np.arange(len(keys))
    nth = np.empty(len(keys), dtype=np.uint64)
    nth[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return mix(keys + nth * U64(0xD6E8FEB86659FD93))
