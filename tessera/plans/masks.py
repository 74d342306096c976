"""Masks of 8 by 16 pixels from digests of the documents' texts, twenty an image; polygons on a grid of 16 by 16."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import masks as M
from tessera.plans.common import query, r6, table

HEIGHT, WIDTH = 8, 16


def digest_runs(spark, sf_dir, *salts: str) -> DataFrame:
    """``doc_id, image, score, start, stop``: the bits that the digests of text and each salt have in common, as runs."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.floor(F.col("doc_id") / 20).alias("image"), F.col("n_chars").alias("score"), F.coalesce("text", F.lit("")).alias("text"))
    bits = None
    for salt in salts:
        digits = F.split(F.md5(F.concat("text", F.lit(salt)).cast("binary")), "")
        own = F.split(F.array_join(F.transform(digits, lambda c: F.lpad(F.conv(c, 16, 2), 4, "0")), ""), "")
        bits = own if bits is None else F.zip_with(bits, own, lambda a, b: F.least(a, b))
    d = d.select("doc_id", "image", "score", bits.alias("bits"))
    on = lambda p: F.get("bits", p) == "1"
    places = F.sequence(F.lit(0), F.lit(HEIGHT * WIDTH - 1))
    starts = F.filter(places, lambda p: on(p) & ((p == 0) | ~on(p - 1)))
    stops = F.transform(F.filter(places, lambda p: on(p) & ((p == HEIGHT * WIDTH - 1) | ~on(p + 1))), lambda p: p + 1)
    each = d.select("doc_id", "image", "score", F.explode(F.arrays_zip(starts.alias("start"), stops.alias("stop"))).alias("r"))
    return each.select("doc_id", "image", "score", F.col("r.start").cast("long").alias("start"), F.col("r.stop").cast("long").alias("stop"))


def _bit(*salts: str) -> str:
    return " and ".join(f"((strpos('0123456789abcdef', md5(coalesce(text, '') || '{s}')[p // 4 + 1]) - 1) >> (3 - p % 4)) & 1 = 1" for s in salts)


def _pixels(*salts: str) -> str:
    return f"px as (select doc_id, doc_id // 20 as image, n_chars as score, p from documents, range({HEIGHT * WIDTH}) r(p) where {_bit(*salts)})"


_ISLANDS = "select {0}, min(p) as start, max(p) + 1 as stop from (select *, p - row_number() over (partition by {0} order by p) as island from {1}) group by {0}, island"


@query(f"with {_pixels('', 'x')}, own as (select image, p, first(doc_id order by score desc, doc_id) as doc_id from px group by 1, 2) {_ISLANDS.format('image, doc_id', 'own')}")
def j30_overlap_owner(spark, sf_dir):
    """Where masks of an image overlap, the pixel goes to the better object."""
    return M.owned_runs(digest_runs(spark, sf_dir, "", "x"), ["image"], "doc_id", "score")


_IOM = f"""{_pixels('', 'x')}, sizes as (select doc_id, image, score, count(*) as area from px group by all),
pairs as (select x.image, x.doc_id as a, y.doc_id as b, count(*) as shared from px x join px y on x.image = y.image and x.p = y.p and x.doc_id < y.doc_id group by all),
ious as (select pairs.*, shared / (s.area + t.area - shared) as iou, shared / (greatest(1, least(s.area, t.area)) + 1e-8) as iom from pairs join sizes s on s.doc_id = a join sizes t on t.doc_id = b)"""


@query(f"with {_IOM} select image, a, b, shared, round(iou, 6) as iou, round(iom, 6) as iom from ious")
def j18_mask_overlaps(spark, sf_dir):
    """Shared pixels, IoU and shared part of the smaller, of an image's masks that share any."""
    out = M.ious(digest_runs(spark, sf_dir, "", "x"), ["image"], "doc_id")
    return out.select("image", "a", "b", "shared", r6("iou").alias("iou"), r6("iom").alias("iom"))


@query(f"""with recursive {_IOM}, foes as (select doc_id, list(foe) as foes from (select a as doc_id, b as foe from ious where iom > 0.3 union all select b, a from ious where iom > 0.3) group by 1),
o as (select d.doc_id, d.doc_id // 20 as image, coalesce(foes, []) as foes, row_number() over (partition by d.doc_id // 20 order by n_chars desc, d.doc_id) as rn from documents d left join foes using (doc_id)),
k as (select image, 0::bigint as rn, null::bigint as doc_id, false as keep, []::bigint[] as kept from (select distinct image from o)
  union all select o.image, o.rn, o.doc_id, not list_has_any(kept, foes), case when list_has_any(kept, foes) then kept else list_append(kept, o.doc_id) end from k join o on o.image = k.image and o.rn = k.rn + 1)
select image, doc_id, keep from k where rn > 0""")
def n05_masks_apart(spark, sf_dir):
    """Of masks of an image that share more than 0.3 of the smaller, the better stays."""
    items = table(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / 20).alias("image"), "doc_id", F.col("n_chars").alias("score"))
    return M.keep_apart(items, digest_runs(spark, sf_dir, "", "x"), ["image"], "doc_id").select("image", "doc_id", "keep")


@query(f"with px as (select doc_id, lang, doc_id // 20 as image, p from documents, range({HEIGHT * WIDTH}) r(p) where {_bit('', 'x')}), u as (select distinct image, p from px) {_ISLANDS.format('image', 'u')}")
def d08_mask_union_runs(spark, sf_dir):
    """The union of an image's masks, as runs."""
    return M.united(digest_runs(spark, sf_dir, "", "x"), ["image"])


_NEAR = ", ".join(f"case when p // {HEIGHT} + ({dx}) between 0 and {WIDTH - 1} and p % {HEIGHT} + ({dy}) between 0 and {HEIGHT - 1} then {{0}}[p + 1 + ({dx * HEIGHT + dy})] else 0 end" for dx in (-1, 0, 1) for dy in (-1, 0, 1))
_EDGE = f"list_transform(range({HEIGHT * WIDTH}), lambda p: (" + " or ".join(f"{{0}}[p + 1] <> {{0}}[p + 1 + {right} + {below}]" for right, below in ((f"case when p // {HEIGHT} < {WIDTH - 1} then {HEIGHT} else 0 end", "0"), ("0", f"case when p % {HEIGHT} < {HEIGHT - 1} then 1 else 0 end"), (f"case when p // {HEIGHT} < {WIDTH - 1} then {HEIGHT} else 0 end", f"case when p % {HEIGHT} < {HEIGHT - 1} then 1 else 0 end"))) + ")::int)"
_SUM = "list_sum(list_transform(range(128), lambda p: {0}[p + 1] * {1}[p + 1]))"


@query(f"""with m as (select doc_id, list_transform(range(128), lambda p: case when doc_id % 7 > 0 and {_bit('', 'x')} then 1 else 0 end) as t, list_transform(range(128), lambda p: case when doc_id % 11 > 0 and {_bit('', 'y')} then 1 else 0 end) as d from documents),
e as (select *, {_EDGE.format('t')} as et, {_EDGE.format('d')} as ed from m),
g as (select *, list_transform(range(128), lambda p: greatest({_NEAR.format('et')})) as gt, list_transform(range(128), lambda p: greatest({_NEAR.format('ed')})) as gd from e),
n as (select doc_id, {_SUM.format('t', 'd')} as shared, list_sum(t) + list_sum(d) as pixels, list_sum(et) as nt, list_sum(ed) as nd, {_SUM.format('et', 'gd')} as mt, {_SUM.format('ed', 'gt')} as md from g),
s as (select doc_id, case when pixels - shared > 0 then shared / (pixels - shared) else 0 end as j, case when nd > 0 then md / nd else 1 end as p, case when nt > 0 then mt / nt else 1 end as r from n),
f as (select doc_id // 20 as image, j, case when p + r > 0 then 2 * p * r / (p + r) else 0 end as f from s)
select image, count(*) as n, round(avg(j), 6) as j, round(sum(f) / (count(*) + 1e-9), 6) as f, round((avg(j) + sum(f) / (count(*) + 1e-9)) * 0.5, 6) as jf from f group by 1""")
def a31_boundary(spark, sf_dir):
    """Region and boundary agreement of matched masks, by image; some truths and some detections are empty."""
    truth = digest_runs(spark, sf_dir, "", "x").where("doc_id % 7 > 0")
    found = digest_runs(spark, sf_dir, "", "y").where("doc_id % 11 > 0")
    pairs = table(spark, sf_dir, "documents").select("doc_id", F.floor(F.col("doc_id") / 20).alias("image"))
    out = M.mean_boundary_scores(M.boundary_scores(pairs, truth, found, ["doc_id"], HEIGHT, WIDTH), ["image"])
    return out.select("image", "n", r6("j").alias("j"), r6("f").alias("f"), r6("jf").alias("jf"))


GRID = 16
_BYTE = "(('0x' || md5(coalesce(text, '') || '{0}')[{1}:{2}])::bigint % 19 - 1)"


def polygon_parts(spark, sf_dir) -> DataFrame:
    """``doc_id, parts``: five corners from a digest, some past the grid's edge; every third document has a second part of three."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    at = lambda salt, k: (F.conv(F.substring(F.md5(F.concat("text", F.lit(salt)).cast("binary")), 2 * k + 1, 2), 16, 10).cast("int") % 19 - 1).cast("double")
    part = lambda salt, n: F.array(*(at(salt, k) for k in range(2 * n)))
    return d.select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.array(part("p", 5), part("q", 3))).otherwise(F.array(part("p", 5))).alias("parts"))


def _edges(salt: str, n: int) -> str:
    at = [_BYTE.format(salt, 2 * k + 1, 2 * k + 2) for k in range(2 * n)]
    return "[" + ", ".join(f"{{'x1': {at[2 * i]}, 'y1': {at[2 * i + 1]}, 'x2': {at[2 * (i + 1) % (2 * n)]}, 'y2': {at[(2 * (i + 1) + 1) % (2 * n)]}}}" for i in range(n)) + "]"


@query(f"""with e as (select doc_id, 0 as part, unnest({_edges('p', 5)}, recursive := true) from documents union all select doc_id, 1, unnest({_edges('q', 3)}, recursive := true) from documents where doc_id % 3 = 0),
c as (select doc_id, part, x, y1 + (x + 0.5::double - x1) * (y2 - y1) / (x2 - x1) as y from e, range({GRID}) r(x) where (x1 <= x + 0.5) <> (x2 <= x + 0.5)),
g as (select doc_id, part, x, row from (select distinct doc_id, part, x from c), range({GRID}) r(row)),
i as (select distinct g.doc_id, g.x * {GRID} + row as p from g join c using (doc_id, part, x) group by g.doc_id, g.part, g.x, row having count(*) filter (c.y <= row + 0.5) % 2 = 1)
{_ISLANDS.format('doc_id', 'i')}""")
def f11_polygons(spark, sf_dir):
    """Polygons of an annotation, filled by scan lines."""
    return M.polygon_runs(polygon_parts(spark, sf_dir), ["doc_id"], "parts", GRID, GRID)


_LETTERS = "list_reduce(list_transform(range(0, len_of(x)), lambda g: chr((48 + ((x >> (5 * g)) & 31) + case when g < len_of(x) - 1 then 32 else 0 end)::int)), lambda a, b: a || b)".replace("len_of(x)", "(case when x between -16 and 15 then 1 when x between -512 and 511 then 2 else 3 end)")


@query(f"""with {_pixels('', 'x')}, r as ({_ISLANDS.format('doc_id', 'px')}), l as (select doc_id, list_append(flatten(list([start, stop] order by start)), 128) as ends, sum(stop - start)::bigint as area from r group by 1),
k as (select doc_id, area, case when ends[-2] = 128 then ends[:-2] else ends end as ends from l),
c as (select doc_id, area, list_transform(ends, lambda e, i: e - case when i = 1 then 0 else ends[i - 1] end) as counts from k),
d as (select *, list_transform(counts, lambda c, i: (c - case when i > 3 then counts[i - 2] else 0 end)::bigint) as xs from c)
select doc_id, counts, list_reduce(list_transform(xs, lambda x: {_LETTERS}), lambda a, b: a || b) as rle, area from d""")
def f11_compressed(spark, sf_dir):
    """Run lengths, their text form, and the area of what that is read back to."""
    runs = digest_runs(spark, sf_dir, "", "x")
    coded = M.run_counts(runs, ["doc_id"], HEIGHT * WIDTH).withColumn("rle", M.compressed(F.col("counts")))
    back = M.areas(M.mask_runs(M.decompressed(coded.select("doc_id", "rle"), ["doc_id"], "rle"), ["doc_id"]), ["doc_id"])
    return coded.join(back, "doc_id").select("doc_id", "counts", "rle", "area")
