"""Boxes as numpy arrays, a row each of x0, y0, x1, y1; the same measures as the column expressions, row by row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def rounded(x: np.ndarray, digits: int) -> np.ndarray:
    """Rounded as SQL engines do: the product with a power of ten, half away from zero."""
    return np.copysign(np.floor(np.abs(x) * 10.0**digits + 0.5), x) / 10.0**digits


def inter(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    w = np.maximum(0.0, np.minimum(a[:, 2], b[:, 2]) - np.maximum(a[:, 0], b[:, 0]))
    return w * np.maximum(0.0, np.minimum(a[:, 3], b[:, 3]) - np.maximum(a[:, 1], b[:, 1]))


def area(a: np.ndarray) -> np.ndarray:
    return (a[:, 2] - a[:, 0]) * (a[:, 3] - a[:, 1])


def ratio(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """0 where nothing is to be shared."""
    return np.divide(x, y, out=np.zeros(len(x)), where=y > 0)


def iou(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    both = inter(a, b)
    return ratio(both, area(a) + area(b) - both)


def giou(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    hull = (np.maximum(a[:, 2], b[:, 2]) - np.minimum(a[:, 0], b[:, 0])) * (np.maximum(a[:, 3], b[:, 3]) - np.minimum(a[:, 1], b[:, 1]))
    both = inter(a, b)
    union = area(a) + area(b) - both
    return ratio(both, union) - ratio(hull - union, hull)


def ioa(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ratio(inter(a, b), area(b))


def iom(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return inter(a, b) / (np.maximum(1.0, np.minimum(area(a), area(b))) + 1e-8)


def centre_similarity(a: np.ndarray, b: np.ndarray, zero_distance: float = 2.0) -> np.ndarray:
    dx, dy = ((a[:, k] + a[:, k + 2] - b[:, k] - b[:, k + 2]) / 2 for k in (0, 1))
    return np.maximum(0.0, 1 - np.sqrt(dx * dx + dy * dy) / zero_distance)


def sharing(a: np.ndarray, b: np.ndarray, size: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in ``a`` and ``b`` of boxes that share an area, by rows of ``a``, all of a row's at once; ``size`` pairs are looked at at a time. No box is empty."""
    x0, y0, x1, y1 = (np.ascontiguousarray(b[:, k]) for k in range(4))
    step = max(1, size // max(1, len(b)))
    for k in range(0, len(a), step):
        p = a[k : k + step]
        meet = (p[:, 0, None] < x1) & (x0 < p[:, 2, None]) & (p[:, 1, None] < y1) & (y0 < p[:, 3, None])
        i, j = np.nonzero(meet)
        yield i + k, j


class Grid:
    """Boxes by the cells that they touch, for those that may share an area with one box."""

    def __init__(self, boxes: np.ndarray, cell: float):
        self.cell = cell
        low, high = np.floor(boxes[:, :2] / cell).astype(np.int64), np.floor(boxes[:, 2:] / cell).astype(np.int64)
        tall = high[:, 1] - low[:, 1] + 1
        n = (high[:, 0] - low[:, 0] + 1) * tall
        which = np.repeat(np.arange(len(boxes)), n)
        at = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        x, y = low[which, 0] + at // tall[which], low[which, 1] + at % tall[which]
        order = np.lexsort((which, y, x))
        x, y, which = x[order], y[order], which[order]
        cuts = np.flatnonzero((np.diff(x) != 0) | (np.diff(y) != 0)) + 1
        held = np.vstack((boxes.T, area(boxes)[None]))
        self.cells = {(int(x[w]), int(y[w])): (ids, held[:, ids]) for w, ids in zip([0, *cuts], np.split(which, cuts), strict=True)} if len(which) else {}

    def near(self, box: tuple[float, ...]) -> tuple[np.ndarray, np.ndarray]:
        """Places, some of them more than once, of the boxes in the cells of ``box``, and their IoU with it."""
        x0, y0, x1, y1 = box
        c = self.cell
        found = [f for x in range(int(x0 // c), int(x1 // c) + 1) for y in range(int(y0 // c), int(y1 // c) + 1) if (f := self.cells.get((x, y)))]
        if not found:
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        ids, (bx0, by0, bx1, by1, areas) = found[0] if len(found) == 1 else (np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found], axis=1))
        both = np.maximum(0.0, np.minimum(bx1, x1) - np.maximum(bx0, x0)) * np.maximum(0.0, np.minimum(by1, y1) - np.maximum(by0, y0))
        union = (x1 - x0) * (y1 - y0) + areas - both
        return ids, np.divide(both, union, out=np.zeros(len(ids)), where=union > 0)
