"""Repeatable randomness: a uniform number is a hash of seed and key, so a lost task draws the same again."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(seed: int | str, *key: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(k.cast("string") for k in key)).cast("binary"))


def uniform(seed: int | str, *key: Column) -> Column:
    """In 0..1, 1 excluded: the digest's first 48 bits."""
    return F.conv(F.substring(digest(seed, *key), 1, 12), 16, 10).cast("double") / float(1 << 48)


def uniform_in(low: float, high: float, seed: int | str, *key: Column) -> Column:
    return low + (high - low) * uniform(seed, *key)


def weighted_choice(options: list[tuple[str, float]], u: Column) -> Column:
    """The option whose share of the cumulated weights holds ``u``."""
    total, at, out = sum(w for _, w in options), 0.0, None
    for name, weight in options[:-1]:
        at += weight / total
        out = F.when(u < at, name) if out is None else out.when(u < at, name)
    return F.lit(options[-1][0]) if out is None else out.otherwise(options[-1][0])


def hemisphere(u: Column, v: Column, low: float = 0.0, high: float = 90.0) -> Column:
    """Unit vector of an elevation in ``low..high`` degrees and any azimuth."""
    elevation, azimuth = F.radians(low + (high - low) * u), F.radians(360.0 * v)
    return F.array(F.cos(elevation) * F.cos(azimuth), F.cos(elevation) * F.sin(azimuth), F.sin(elevation))


def point_in(box: Column, seed: int | str, *key: Column) -> Column:
    """A random point of an ``x0, y0, x1, y1`` box."""
    u, v = uniform(f"{seed}x", *key), uniform(f"{seed}y", *key)
    return F.array(box[0] + u * (box[2] - box[0]), box[1] + v * (box[3] - box[1]))


def noisy_box(box: Column, scale: float, most: float, seed: int | str, *key: Column) -> Column:
    """Each edge moved by up to ``scale`` of the box's side, by ``most`` at most, and put back in order."""
    def moved(i: int) -> Column:
        side = F.least(scale * (box[2 + i % 2] - box[i % 2]), F.lit(most))
        return box[i] + (2 * uniform(f"{seed}{i}", *key) - 1) * side

    e = [moved(i) for i in range(4)]
    return F.array(F.least(e[0], e[2]), F.least(e[1], e[3]), F.greatest(e[0], e[2]), F.greatest(e[1], e[3]))
