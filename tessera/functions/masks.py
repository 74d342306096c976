"""Binary masks as column-major run lengths, the first run of zeros; numpy on one group at a time."""

from __future__ import annotations

from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def encode(mask: np.ndarray) -> list[int]:
    flat = np.concatenate(([0], np.asarray(mask, dtype=np.uint8).ravel(order="F")))
    edges = np.flatnonzero(np.diff(flat)) if len(flat) > 1 else np.zeros(0, int)
    return np.diff(np.concatenate(([0], edges, [mask.size]))).astype(int).tolist()


def decode(counts: list[int], height: int, width: int) -> np.ndarray:
    values = np.arange(len(counts)) % 2 == 1
    return np.repeat(values, counts).reshape((height, width), order="F")


def area(counts: Column) -> Column:
    """Sum of the runs of ones, without decoding."""
    ones = F.filter(counts, lambda c, i: i % 2 == 1)
    return F.aggregate(ones, F.lit(0).cast("long"), lambda s, c: s + c)


def box(mask: np.ndarray, inclusive: bool = True) -> list[int]:
    """x0, y0, x1, y1; the far edge is the last pixel, or the one after it if not ``inclusive``. Empty: zeros."""
    ys, xs = np.nonzero(mask)
    if not len(xs):
        return [0, 0, 0, 0]
    more = 0 if inclusive else 1
    return [int(xs.min()), int(ys.min()), int(xs.max()) + more, int(ys.max()) + more]


def iou(a: np.ndarray, b: np.ndarray) -> float:
    """Two empty masks agree."""
    union = np.logical_or(a, b).sum()
    return float(np.logical_and(a, b).sum() / union) if union else 1.0


def iom(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.logical_and(a, b).sum() / (max(1, min(a.sum(), b.sum())) + 1e-8))


def union(masks: list[np.ndarray], scores: list[float], shape: tuple[int, int]) -> tuple[np.ndarray, float]:
    """All instances as one mask with their mean score; none: an empty mask, 0."""
    if not masks:
        return np.zeros(shape, dtype=bool), 0.0
    return np.logical_or.reduce(masks), float(np.mean(scores))


def components(mask: np.ndarray) -> tuple[np.ndarray, int]:
    """Labels (0 outside) of the eight-connected regions, numbered in scan order."""
    labels, n = np.zeros(mask.shape, dtype=np.int32), 0
    h, w = mask.shape
    for y, x in zip(*np.nonzero(mask), strict=True):
        if labels[y, x]:
            continue
        n += 1
        labels[y, x] = n
        todo = deque([(y, x)])
        while todo:
            cy, cx = todo.popleft()
            for ny in range(max(0, cy - 1), min(h, cy + 2)):
                for nx in range(max(0, cx - 1), min(w, cx + 2)):
                    if mask[ny, nx] and not labels[ny, nx]:
                        labels[ny, nx] = n
                        todo.append((ny, nx))
    return labels, n


def dilate(mask: np.ndarray, radius: int) -> np.ndarray:
    out = mask.copy()
    for dy in range(-radius, radius + 1):
        for dx in range(-radius, radius + 1):
            if dy * dy + dx * dx <= radius * radius:
                moved = np.zeros_like(mask)
                h, w = mask.shape
                moved[max(0, dy) : h + min(0, dy), max(0, dx) : w + min(0, dx)] = mask[max(0, -dy) : h + min(0, -dy), max(0, -dx) : w + min(0, -dx)]
                out |= moved
    return out


def boundary(mask: np.ndarray) -> np.ndarray:
    """Pixels that differ from the one to the right, below, or both."""
    m = np.pad(mask, ((0, 1), (0, 1)), mode="edge")
    here = m[:-1, :-1]
    return (here != m[:-1, 1:]) | (here != m[1:, :-1]) | (here != m[1:, 1:])


def boundary_f(a: np.ndarray, b: np.ndarray, radius: int = 1) -> float:
    """F measure of boundaries within ``radius``; both without boundary: 1, one without: 0."""
    x, y = boundary(a), boundary(b)
    if not x.any() or not y.any():
        return float(x.any() == y.any())
    p, r = (x & dilate(y, radius)).sum() / x.sum(), (y & dilate(x, radius)).sum() / y.sum()
    return float(2 * p * r / (p + r)) if p + r else 0.0


def keep_apart(masks: list[np.ndarray], scores: list[float], limit: float = 0.3) -> tuple[list[int], list[int]]:
    """(kept, removed) places: best first, a mask goes if its shared part of the smaller with a kept one is above ``limit``."""
    kept: list[int] = []
    for i in sorted(range(len(masks)), key=lambda i: (-scores[i], i)):
        if all(iom(masks[i], masks[k]) <= limit for k in kept):
            kept.append(i)
    return kept, [i for i in range(len(masks)) if i not in kept]


def measured(df: DataFrame, key: str, counts: str, height: int, width: int) -> DataFrame:
    """``key, area, x0, y0, x1, y1, regions, largest`` of each mask."""

    def run(frames):
        for f in frames:
            out = []
            for k, c in zip(f[key], f[counts], strict=True):
                m = decode(list(c), height, width)
                labels, n = components(m)
                out.append((k, int(m.sum()), *box(m, inclusive=False), n, int(np.bincount(labels.ravel())[1:].max(initial=0))))
            yield pd.DataFrame(out, columns=[key, "area", "x0", "y0", "x1", "y1", "regions", "largest"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, counts).mapInPandas(run, f"{key} {kind}, area long, x0 long, y0 long, x1 long, y1 long, regions long, largest long")
