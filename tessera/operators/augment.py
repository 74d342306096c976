"""Augmentations of datapoints: what happens to boxes when their image is flipped, jittered, turned or set into a mosaic.

Draws are hashes of a seed and the image (or the video, for frames that move
together), so a task that runs again moves nothing else. Boxes are xyxy in
pixels; images hold ``width`` and ``height``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import boxes as B
from tessera.functions import sampling
from tessera.operators.rank import global_rank


def flipped(box: Column, width: Column) -> Column:
    return F.array(width - box[2], box[1], width - box[0], box[3])


def with_area(objects: DataFrame, box: Column, least: float) -> DataFrame:
    """``box``, ``area`` and ``valid``: whether at least ``least`` of the box's area before, and more than nothing, is left."""
    out = objects.withColumn("__before", B.area_xyxy(F.col("box"))).withColumn("box", box).withColumn("area", B.area_xyxy(F.col("box")))
    return out.withColumn("valid", (F.col("area") > 0) & (F.col("area") >= least * F.col("__before"))).drop("__before")


def jittered(objects: DataFrame, image: str, seed: int, scale: tuple[float, float] = (0.1, 2.0), aspect: tuple[float, float] = (0.75, 1.33), size: tuple[int, int] = (640, 640), chance: float = 0.5) -> DataFrame:
    """Large-scale jitter of ``objects(image, width, height, box)``: with ``chance`` an image is cut to a window of drawn area, shape and place, which is then made ``size`` large.

    A window larger than the image begins at its corner. Images that aren't drawn stay; ``width`` and ``height`` become those of the result.
    """
    u = lambda k: sampling.uniform(f"{seed}.{k}", F.col(image))
    area = F.col("width") * F.col("height") * (scale[0] + (scale[1] - scale[0]) * u(1))
    shape = F.exp(math.log(aspect[0]) + (math.log(aspect[1]) - math.log(aspect[0])) * u(2))
    w, h = F.round(F.sqrt(area * shape)), F.round(F.sqrt(area / shape))
    corner = lambda full, part, k: F.floor(u(k) * (F.greatest(full - part, F.lit(0.0)) + 1))
    each = objects.withColumn("__drawn", u(0) < chance).withColumn("__w", w).withColumn("__h", h)
    each = each.withColumn("__x", corner(F.col("width"), F.col("__w"), 3)).withColumn("__y", corner(F.col("height"), F.col("__h"), 4))
    b = F.col("box")
    moved = B.clipped(F.array(b[0] - F.col("__x"), b[1] - F.col("__y"), b[2] - F.col("__x"), b[3] - F.col("__y")), F.col("__w"), F.col("__h"))
    out = with_area(each, F.when(F.col("__drawn"), moved).otherwise(b), 0.0)
    sx, sy = size[0] / F.col("__w"), size[1] / F.col("__h")
    out = out.withColumn("box", F.when(F.col("__drawn"), B.scaled(F.col("box"), sx, sy)).otherwise(F.col("box"))).withColumn("area", B.area_xyxy(F.col("box")))
    for name, to in (("width", size[0]), ("height", size[1])):
        out = out.withColumn(name, F.when(F.col("__drawn"), F.lit(float(to))).otherwise(F.col(name)))
    return out.drop("__drawn", "__w", "__h", "__x", "__y")


def turned(objects: DataFrame, image: str, seed: int, degrees: float = 20.0, translate: tuple[float, float] = (0.1, 0.1), scale: tuple[float, float] = (0.8, 1.2), shear: float = 10.0, least: float = 0.1) -> DataFrame:
    """Affine transform of ``objects(image, width, height, box)`` about the image's centre by an angle, a shift, a scale and two shears drawn for it.

    A box becomes the smallest one around its four corners, cut at the image;
    ``valid`` says whether ``least`` of its area before is left.
    """
    u = lambda k: 2 * sampling.uniform(f"{seed}.{k}", F.col(image)) - 1
    angle, sx, sy = (F.radians(F.lit(limit) * u(k)) for k, limit in ((0, degrees), (1, shear), (2, shear)))
    tx, ty = (F.round(F.lit(share) * F.col(side) * u(k)) for k, share, side in ((3, translate[0], "width"), (4, translate[1], "height")))
    grow = scale[0] + (scale[1] - scale[0]) * sampling.uniform(f"{seed}.5", F.col(image))
    names = ("a", "b", "c", "d")
    matrix = (F.cos(angle - sy) / F.cos(sy), -F.cos(angle - sy) * F.tan(sx) / F.cos(sy) - F.sin(angle), F.sin(angle - sy) / F.cos(sy), -F.sin(angle - sy) * F.tan(sx) / F.cos(sy) + F.cos(angle))
    each = objects.withColumns({f"__{n}": grow * m for n, m in zip(names, matrix, strict=True)} | {"__tx": tx, "__ty": ty})
    a, b, c, d = (F.col(f"__{n}") for n in names)
    cx, cy = F.col("width") / 2, F.col("height") / 2
    box = F.col("box")
    corners = [(box[i] - cx, box[j] - cy) for i in (0, 2) for j in (1, 3)]
    xs, ys = [a * x + b * y + cx + F.col("__tx") for x, y in corners], [c * x + d * y + cy + F.col("__ty") for x, y in corners]
    around = F.array(F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys))
    return with_area(each, B.clipped(around, F.col("width"), F.col("height")), least).drop(*(f"__{n}" for n in names), "__tx", "__ty")


def in_cell(box: Column, width: Column, height: Column, x: Column, y: Column, grid: int, out_width: Column, out_height: Column, flip: Column) -> Column:
    """A box of an image that is made small and set into cell (x, y) of a grid on an image of the given size, whose cells end at whole pixels."""
    left, right = (F.floor((x + k) * out_width / grid) for k in (0, 1))
    top, bottom = (F.floor((y + k) * out_height / grid) for k in (0, 1))
    own = F.when(flip, flipped(box, width)).otherwise(box)
    sx, sy = (right - left) / width, (bottom - top) / height
    return F.array(left + own[0] * sx, top + own[1] * sy, left + own[2] * sx, top + own[3] * sy)


def self_mosaic(objects: DataFrame, image: str, seed: int, grid: int = 2, chance: float = 0.15) -> DataFrame:
    """With ``chance`` an image is repeated in every cell of a grid, and its objects stay in one drawn cell."""
    u = lambda k: sampling.uniform(f"{seed}.{k}", F.col(image))
    set_in = in_cell(F.col("box"), F.col("width"), F.col("height"), F.floor(u(1) * grid), F.floor(u(2) * grid), grid, F.col("width"), F.col("height"), F.lit(False))
    return objects.withColumn("box", F.when(u(0) <= chance, set_in).otherwise(F.col("box")))


def mosaics(images: DataFrame, objects: DataFrame, image: str, seed: int, size: tuple[int, int], grid: int = 2) -> DataFrame:
    """``objects`` with their ``mosaic`` and place in it: grid x grid images by a seeded order make one of ``size``, each flipped or not by a draw.

    Images are numbered by range and objects follow by key, so nothing is
    gathered; the last mosaic may have empty cells. Images without objects take
    a cell too.
    """
    order = images.select(image, F.col("width").alias("__w"), F.col("height").alias("__h")).withColumn("__h0", sampling.digest(seed, F.col(image)))
    placed = global_rank(order, F.asc("__h0"), F.asc(image), name="__k").withColumn("mosaic", F.floor((F.col("__k") - 1) / grid**2)).withColumn("cell", (F.col("__k") - 1) % grid**2)
    flip = sampling.uniform(f"{seed}.flip", F.col(image)) < 0.5
    box = in_cell(F.col("box"), F.col("__w"), F.col("__h"), F.col("cell") % grid, F.floor(F.col("cell") / grid), grid, F.lit(float(size[0])), F.lit(float(size[1])), flip)
    return objects.join(placed, image).withColumn("box", box).drop("__w", "__h", "__h0", "__k")
