"""Box expressions. A box is array<double>; the format is in the function's name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def at(b: Column, i: int) -> Column:
    return b[i]


def _max0(x: Column) -> Column:
    return F.greatest(x, F.lit(0.0))


def xywh_to_xyxy(b: Column) -> Column:
    return F.array(b[0], b[1], b[0] + b[2], b[1] + b[3])


def xyxy_to_xywh(b: Column) -> Column:
    return F.array(b[0], b[1], b[2] - b[0], b[3] - b[1])


def cxcywh_to_xyxy(b: Column) -> Column:
    return F.array(b[0] - b[2] / 2, b[1] - b[3] / 2, b[0] + b[2] / 2, b[1] + b[3] / 2)


def xyxy_to_cxcywh(b: Column) -> Column:
    return F.array((b[0] + b[2]) / 2, (b[1] + b[3]) / 2, b[2] - b[0], b[3] - b[1])


def xywh_to_cxcywh(b: Column) -> Column:
    return F.array(b[0] + b[2] / 2, b[1] + b[3] / 2, b[2], b[3])


def cxcywh_to_xywh(b: Column) -> Column:
    return F.array(b[0] - b[2] / 2, b[1] - b[3] / 2, b[2], b[3])


def area_xyxy(b: Column) -> Column:
    return (b[2] - b[0]) * (b[3] - b[1])


def inter_xyxy(a: Column, b: Column) -> Column:
    w = _max0(F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    return w * _max0(F.least(a[3], b[3]) - F.greatest(a[1], b[1]))


def union_xyxy(a: Column, b: Column) -> Column:
    return area_xyxy(a) + area_xyxy(b) - inter_xyxy(a, b)


def _ratio(x: Column, y: Column) -> Column:
    """0 where nothing is to be shared."""
    return F.when(y > 0, x / y).otherwise(F.lit(0.0))


def iou_xyxy(a: Column, b: Column) -> Column:
    return _ratio(inter_xyxy(a, b), union_xyxy(a, b))


def giou_xyxy(a: Column, b: Column) -> Column:
    hull = (F.greatest(a[2], b[2]) - F.least(a[0], b[0])) * (F.greatest(a[3], b[3]) - F.least(a[1], b[1]))
    return iou_xyxy(a, b) - _ratio(hull - union_xyxy(a, b), hull)


def ioa_xyxy(a: Column, b: Column) -> Column:
    """Shared part of the second box."""
    return _ratio(inter_xyxy(a, b), area_xyxy(b))


def iom_xyxy(a: Column, b: Column) -> Column:
    """Shared part of the smaller box, whose area counts as 1 at least."""
    return inter_xyxy(a, b) / (F.greatest(F.lit(1.0), F.least(area_xyxy(a), area_xyxy(b))) + 1e-8)


def point_edge_distances(x: Column, y: Column, b: Column) -> Column:
    """Distances of a point to the left, top, right and bottom edge; all positive inside."""
    return F.array(x - b[0], y - b[1], b[2] - x, b[3] - y)


def centre_similarity(a: Column, b: Column, zero_distance: float = 2.0) -> Column:
    """1 for equal centres, 0 from ``zero_distance`` on."""
    dx, dy = (a[0] + a[2] - b[0] - b[2]) / 2, (a[1] + a[3] - b[1] - b[3]) / 2
    return _max0(1 - F.sqrt(dx * dx + dy * dy) / zero_distance)


def normalised(b: Column, width: Column, height: Column) -> Column:
    """Divided by the image's size and clamped to 0..1."""
    one = lambda x: F.least(F.lit(1.0), _max0(x))
    return F.array(one(b[0] / width), one(b[1] / height), one(b[2] / width), one(b[3] / height))


def scaled(b: Column, sx: Column | float, sy: Column | float) -> Column:
    return F.array(b[0] * sx, b[1] * sy, b[2] * sx, b[3] * sy)


def clipped(b: Column, width: Column | float, height: Column | float) -> Column:
    w, h = (x if isinstance(x, Column) else F.lit(float(x)) for x in (width, height))
    return F.array(F.least(_max0(b[0]), w), F.least(_max0(b[1]), h), F.least(_max0(b[2]), w), F.least(_max0(b[3]), h))


def cropped(b: Column, top: float, left: float, height: float, width: float) -> Column:
    """Moved to the crop's corner and clamped to its size."""
    return clipped(F.array(b[0] - left, b[1] - top, b[2] - left, b[3] - top), width, height)


def nonempty(b: Column, threshold: float = 0.0) -> Column:
    return (b[2] - b[0] > threshold) & (b[3] - b[1] > threshold)


def inside(b: Column, width: Column | float, height: Column | float, margin: float = 0.0) -> Column:
    return (b[0] >= -margin) & (b[1] >= -margin) & (b[2] < width + margin) & (b[3] < height + margin)


def is_zero_box(b: Column) -> Column:
    """Missing, short, or all of the first four at most 0."""
    return b.isNull() | (F.size(b) < 4) | F.coalesce((b[0] <= 0) & (b[1] <= 0) & (b[2] <= 0) & (b[3] <= 0), F.lit(True))


def centre_in_margin(b: Column, margin: float = 0.025) -> Column:
    """Whether a normalised box's centre keeps ``margin`` from every border."""
    x, y = (b[0] + b[2]) / 2, (b[1] + b[3]) / 2
    return (x > margin) & (x < 1 - margin) & (y > margin) & (y < 1 - margin)


def adaptive_normalised(b: Column, width: Column, height: Column) -> Column:
    """Absolute only if a coordinate exceeds 1."""
    return F.when(F.array_max(b) > 1.0, F.array(b[0] / width, b[1] / height, b[2] / width, b[3] / height)).otherwise(b)
