"""Augmentations: parts stand for objects in the image of their brand, ten parts for an image of a mosaic."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import augment
from tessera.plans.common import query
from tessera.plans.geometry import BOX_SQL, boxes

WIDTH, HEIGHT = 1080.0, 1060.0
U = "(('0x' || md5('{0}|' || {1})[1:12])::bigint / 281474976710656.0::double)"
CLIPPED = "least(greatest({0}, 0), {1})"


def sized(spark, sf_dir):
    return boxes(spark, sf_dir).withColumn("width", F.lit(WIDTH)).withColumn("height", F.lit(HEIGHT))


def _rounded(df, *names):
    return df.select(*names, *(F.round(F.col("box")[k], 4).alias(c) for k, c in enumerate(("x0", "y0", "x1", "y1"))))


def _u(seed, k, key="brand"):
    return U.format(f"{seed}.{k}", key)


@query(f"""with {BOX_SQL}, g as (select *, {_u(31, 0)} < 0.5 as drawn, 1080.0::double * 1060.0::double * (0.1::double + (2.0::double - 0.1::double) * {_u(31, 1)}) as area, exp(ln(0.75::double) + (ln(1.33::double) - ln(0.75::double)) * {_u(31, 2)}) as shape from box),
s as (select *, round(sqrt(area * shape)) as w, round(sqrt(area / shape)) as h from g),
c as (select *, floor({_u(31, 3)} * (greatest(1080 - w, 0) + 1)) as cx, floor({_u(31, 4)} * (greatest(1060 - h, 0) + 1)) as cy from s),
m as (select id, brand, drawn, w, h, {', '.join(f"case when drawn then {CLIPPED.format(f'{v} - {o}', lim)} else {v} end as {v}" for v, o, lim in (('x0', 'cx', 'w'), ('y0', 'cy', 'h'), ('x1', 'cx', 'w'), ('y1', 'cy', 'h')))} from c)
select id, (x1 - x0) * (y1 - y0) > 0 as valid, case when drawn then 640.0::double else 1080.0::double end as width, {', '.join(f"round(case when drawn then {v} * (640 / {lim}) else {v} end, 4) as {v}" for v, lim in (('x0', 'w'), ('y0', 'h'), ('x1', 'w'), ('y1', 'h')))} from m""")
def u17_jitter(spark, sf_dir):
    """Large-scale jitter: all boxes of an image are cut and made larger together."""
    return _rounded(augment.jittered(sized(spark, sf_dir), "brand", 31), "id", "valid", "width")


@query(f"""with {BOX_SQL}, p as (select *, radians(20.0::double * (2 * {_u(32, 0)} - 1)) as g, radians(10.0::double * (2 * {_u(32, 1)} - 1)) as sx, radians(10.0::double * (2 * {_u(32, 2)} - 1)) as sy, round(0.1::double * 1080 * (2 * {_u(32, 3)} - 1)) as tx, round(0.1::double * 1060 * (2 * {_u(32, 4)} - 1)) as ty, 0.8::double + (1.2::double - 0.8::double) * {_u(32, 5)} as k from box),
m as (select *, k * (cos(g - sy) / cos(sy)) as a, k * (-cos(g - sy) * tan(sx) / cos(sy) - sin(g)) as b, k * (sin(g - sy) / cos(sy)) as c, k * (-sin(g - sy) * tan(sx) / cos(sy) + cos(g)) as d from p),
v as (select id, x0, y0, x1, y1, unnest([x0, x0, x1, x1]) - 540 as px, unnest([y0, y1, y0, y1]) - 530 as py, a, b, c, d, tx, ty from m),
w as (select id, any_value((x1 - x0) * (y1 - y0)) as before, min(a * px + b * py + 540 + tx) as x0, min(c * px + d * py + 530 + ty) as y0, max(a * px + b * py + 540 + tx) as x1, max(c * px + d * py + 530 + ty) as y1 from v group by id),
q as (select id, before, {CLIPPED.format('x0', 1080)} as x0, {CLIPPED.format('y0', 1060)} as y0, {CLIPPED.format('x1', 1080)} as x1, {CLIPPED.format('y1', 1060)} as y1 from w)
select id, (x1 - x0) * (y1 - y0) > 0 and (x1 - x0) * (y1 - y0) >= 0.1::double * before as valid, {', '.join(f'round({c}, 4) as {c}' for c in ('x0', 'y0', 'x1', 'y1'))} from q""")
def u17_affine(spark, sf_dir):
    """Turned, shifted, scaled and sheared images: the boxes around what their boxes become."""
    return _rounded(augment.turned(sized(spark, sf_dir), "brand", 32), "id", "valid")



@query(f"""with {BOX_SQL}, i as (select distinct id // 10 as image from box), k as (select image, row_number() over (order by md5('33|' || image), image) as k, {_u(33, 'flip', 'image')} < 0.5 as f from i),
o as (select id, image, (k - 1) // 4 as mosaic, (k - 1) % 4 as cell, f, x0, y0, x1, y1, (k - 1) % 4 % 2 as cx, (k - 1) % 4 // 2 as cy from box join k on image = id // 10)
select id, mosaic, cell, round(floor(cx * 801.0::double / 2) + case when f then 1080 - x1 else x0 end * ((floor((cx + 1) * 801.0::double / 2) - floor(cx * 801.0::double / 2)) / 1080), 4) as x0, round(floor(cy * 600.0::double / 2) + y0 * ((floor((cy + 1) * 600.0::double / 2) - floor(cy * 600.0::double / 2)) / 1060), 4) as y0,
  round(floor(cx * 801.0::double / 2) + case when f then 1080 - x0 else x1 end * ((floor((cx + 1) * 801.0::double / 2) - floor(cx * 801.0::double / 2)) / 1080), 4) as x1, round(floor(cy * 600.0::double / 2) + y1 * ((floor((cy + 1) * 600.0::double / 2) - floor(cy * 600.0::double / 2)) / 1060), 4) as y1 from o""")
def u17_mosaic(spark, sf_dir):
    """Four images each by a seeded order in one, with their boxes."""
    objects = boxes(spark, sf_dir).withColumn("image", F.floor(F.col("id") / 10)).select("id", "image", "box")
    images = objects.select("image").distinct().withColumn("width", F.lit(WIDTH)).withColumn("height", F.lit(HEIGHT))
    return _rounded(augment.mosaics(images, objects, "image", 33, (801, 600)), "id", "mosaic", "cell")


@query(f"""with {BOX_SQL}, g as (select *, {_u(34, 0)} <= 0.15 as drawn, floor({_u(34, 1)} * 2) as cx, floor({_u(34, 2)} * 2) as cy from box)
select id, {', '.join(f"round(case when drawn then floor({c} * {s} / 2) + {v} * ((floor(({c} + 1) * {s} / 2) - floor({c} * {s} / 2)) / {s}) else {v} end, 4) as {v}" for v, c, s in (('x0', 'cx', '1080.0::double'), ('y0', 'cy', '1060.0::double'), ('x1', 'cx', '1080.0::double'), ('y1', 'cy', '1060.0::double')))} from g""")
def u17_self_mosaic(spark, sf_dir):
    """An image repeated in a grid, its objects in one cell."""
    return _rounded(augment.self_mosaic(sized(spark, sf_dir), "brand", 34), "id")


@query(f"with {BOX_SQL} select id, 1080 - x1 as x0, y0, 1080 - x0 as x1, y1 from box")
def u17_flipped(spark, sf_dir):
    return _rounded(boxes(spark, sf_dir).withColumn("box", augment.flipped(F.col("box"), F.lit(WIDTH))), "id")
