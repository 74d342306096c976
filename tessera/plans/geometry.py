"""Boxes and tracks: parts stand for boxes in the image of their brand, line items for boxes in the frames of an order's video."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import box_arrays as A
from tessera.functions import boxes as B
from tessera.functions import sampling
from tessera.operators import match, overlap
from tessera.plans.common import query, r6, table

BOX_SQL = "box as (select p_partkey as id, p_brand as brand, ((p_partkey * 37) % 1000)::double as x0, ((p_partkey * 91) % 1000)::double as y0, ((p_partkey * 37) % 1000 + 20 + p_partkey % 50)::double as x1, ((p_partkey * 91) % 1000 + 20 + p_size)::double as y1, p_retailprice as score from part)"
INTER = "greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0))"
AREA = "(({0}.x1 - {0}.x0) * ({0}.y1 - {0}.y0))"
IOU = f"{INTER} / ({AREA.format('a')} + {AREA.format('b')} - {INTER})"
HULL = "((greatest(a.x1, b.x1) - least(a.x0, b.x0)) * (greatest(a.y1, b.y1) - least(a.y0, b.y0)))"


def boxes(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    x0, y0 = ((F.col("p_partkey") * k) % 1000 for k in (37, 91))
    box = F.array(*(c.cast("double") for c in (x0, y0, x0 + 20 + F.col("p_partkey") % 50, y0 + 20 + F.col("p_size"))))
    return p.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"), box.alias("box"), F.col("p_retailprice").alias("score"))


#: No box of these tables is longer.
CELL = 72.0


def sides(spark, sf_dir):
    b = boxes(spark, sf_dir)
    return b.select("brand", F.col("id").alias("a"), F.col("box").alias("a_box")), b.select("brand", F.col("id").alias("b"), F.col("box").alias("b_box"), "score")


@query(f"with {BOX_SQL} select a.brand, a.id as a, b.id as b, round({IOU}, 6) as iou from box a join box b on a.brand = b.brand and a.id < b.id and a.x0 < b.x1 and b.x0 < a.x1 and a.y0 < b.y1 and b.y0 < a.y1 where round({IOU}, 6) >= 0.3")
def j17_box_iou(spark, sf_dir):
    a, b = sides(spark, sf_dir)
    return overlap.met_pairs(a, b, ["brand"], CELL, {"iou": lambda p, q: A.rounded(A.iou(p, q), 6)}, lambda m: m["iou"] >= 0.3, below=True)


@query(f"""with {BOX_SQL} select a.id, round({AREA.format('a')}, 6) as area, round((a.x0 + a.x1) / 2, 6) as cx, round((a.y0 + a.y1) / 2, 6) as cy, round(a.x1 - a.x0, 6) as w, round(a.y1 - a.y0, 6) as h,
 round(greatest(0, least(1, a.x1 / 900)), 6) as nx, round(least(greatest(a.x1, 0), 900.0), 6) as clip_x1, (a.x0 >= 0 and a.y0 >= 0 and a.x1 < 900 and a.y1 < 900) as inside from box a""")
def f08_box_formats(spark, sf_dir):
    b, c = F.col("box"), B.xyxy_to_cxcywh(F.col("box"))
    back = B.xywh_to_xyxy(B.cxcywh_to_xywh(c))
    d = boxes(spark, sf_dir).withColumn("c", c).withColumn("back", back)
    n = B.normalised(b, F.lit(900.0), F.lit(900.0))
    return d.select("id", r6(B.area_xyxy(F.col("back"))).alias("area"), r6(F.col("c")[0]).alias("cx"), r6(F.col("c")[1]).alias("cy"), r6(F.col("c")[2]).alias("w"), r6(F.col("c")[3]).alias("h"), r6(n[2]).alias("nx"), r6(B.clipped(b, 900.0, 900.0)[2]).alias("clip_x1"), B.inside(b, 900.0, 900.0).alias("inside"))


@query(f"""with {BOX_SQL} select a.id as a, b.id as b, round({IOU} - ({HULL} - ({AREA.format('a')} + {AREA.format('b')} - {INTER})) / {HULL}, 5) as giou, round({INTER} / {AREA.format('b')}, 5) as ioa,
 round({INTER} / (greatest(1.0, least({AREA.format('a')}, {AREA.format('b')})) + 1e-8), 5) as iom, round(greatest(0, 1 - sqrt(((a.x0 + a.x1 - b.x0 - b.x1) / 2)**2 + ((a.y0 + a.y1 - b.y0 - b.y1) / 2)**2) / 100), 5) as near
 from box a join box b on a.brand = b.brand and a.id < b.id and a.x0 < b.x1 and b.x0 < a.x1 and a.y0 < b.y1 and b.y0 < a.y1""")
def f09_box_overlaps(spark, sf_dir):
    a, b = sides(spark, sf_dir)
    r5 = lambda f, *more: lambda p, q: A.rounded(f(p, q, *more), 5)
    measures = {"giou": r5(A.giou), "ioa": r5(A.ioa), "iom": r5(A.iom), "near": r5(A.centre_similarity, 100.0)}
    return overlap.met_pairs(a, b, ["brand"], CELL, measures, below=True).drop("brand")


@query(f"with {BOX_SQL} select brand, count(*) as n, count(*) filter ((x0 + x1) / 2000 > 0.025 and (x0 + x1) / 2000 < 0.975 and (y0 + y1) / 2000 > 0.025 and (y0 + y1) / 2000 < 0.975) as central from box group by brand")
def p11_centre_margin(spark, sf_dir):
    unit = B.scaled(F.col("box"), 1 / 1000, 1 / 1000)
    return boxes(spark, sf_dir).groupBy("brand").agg(F.count("*").alias("n"), F.count_if(B.centre_in_margin(unit)).alias("central"))


@query(f"with {BOX_SQL} select id, round(greatest(0, least(x0 - 100, 600)), 6) as x0, round(greatest(0, least(x1 - 100, 600)), 6) as x1 from box where least(greatest(x1 - 100, 0), 600) - least(greatest(x0 - 100, 0), 600) > 0 and least(greatest(y1 - 200, 0), 500) - least(greatest(y0 - 200, 0), 500) > 0")
def p26_crop(spark, sf_dir):
    c = B.cropped(F.col("box"), 200.0, 100.0, 500.0, 600.0)
    return boxes(spark, sf_dir).withColumn("c", c).where(B.nonempty(F.col("c"))).select("id", r6(F.col("c")[0]).alias("x0"), r6(F.col("c")[2]).alias("x1"))


@query("select l_orderkey, count(*) as n, count(*) filter (l_linenumber % 3 = 0 or l_discount <= 0) as zero_boxes from lineitem group by 1")
def p24_zero_boxes(spark, sf_dir):
    d = F.col("l_discount")
    box = F.when(F.col("l_linenumber") % 3 != 0, F.array(d, d, d, d))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.count_if(B.is_zero_box(box)).alias("zero_boxes"))


@query("select l_orderkey, count(*) as queries from lineitem group by 1 having count(*) filter (l_discount = 0) = 0")
def p14_no_zero_area(spark, sf_dir):
    """Queries that touch any zero-area box go (anti-join on the exploded references)."""
    li = table(spark, sf_dir, "lineitem")
    zero = li.where("l_discount = 0").select("l_orderkey").distinct()
    return li.join(zero, "l_orderkey", "left_anti").groupBy("l_orderkey").agg(F.count("*").alias("queries"))


@query(f"with {BOX_SQL} select id, round(case when greatest(x0, x1) / (1 + 999 * (id % 2)) > 1 then x1 / (1 + 999 * (id % 2)) / 1100 else x1 / (1 + 999 * (id % 2)) end, 6) as x1 from box where y1 <= x1 or id % 2 = 0 and y1 <= 1000 and x1 <= 1000")
def f16_adaptive_box(spark, sf_dir):
    scale = 1 + 999 * (F.col("id") % 2)
    b = boxes(spark, sf_dir).where("box[3] <= box[2] or id % 2 = 0 and box[3] <= 1000 and box[2] <= 1000")
    return b.select("id", r6(B.adaptive_normalised(F.transform("box", lambda x: x / scale), F.lit(1100.0), F.lit(1100.0))[2]).alias("x1"))


FRAME_SQL = """f as (select l_orderkey as video, l_linenumber as frame, l_suppkey % 2 as g, l_partkey % 2 as d, min(l_quantity) as q, min(l_discount) as s, min(l_tax) as t from lineitem group by all),
gt as (select video, g, frame, min(q) as x0, min(frame)::double as y0, min(q) + 20 as x1, min(frame) + 10 + min(t) * 100 as y1 from f group by video, g, frame),
dt as (select video, d, frame, min(q) + min(s) * 50 as x0, min(frame)::double as y0, min(q) + min(s) * 50 + 20 as x1, min(frame) + 12.0 as y1 from f group by video, d, frame)"""


def frame_boxes(spark, sf_dir):
    f = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("video"), F.col("l_linenumber").alias("frame"), (F.col("l_suppkey") % 2).alias("g"), (F.col("l_partkey") % 2).alias("d")).agg(F.min("l_quantity").alias("q"), F.min("l_discount").alias("s"), F.min("l_tax").alias("t"))
    of = lambda k: f.groupBy("video", k, "frame").agg(F.min("q").alias("q"), F.min("s").alias("s"), F.min("t").alias("t"))
    y, q = F.col("frame").cast("double"), F.col("q")
    gt = of("g").select("video", "g", "frame", F.array(q, y, q + 20, y + 10 + F.col("t") * 100).alias("a_box"))
    at = q + F.col("s") * 50
    return gt, of("d").select("video", "d", "frame", F.array(at, y, at + 20, y + 12).alias("b_box"))


@query(f"""with {FRAME_SQL}, i as (select a.video, a.g, b.d, sum({INTER}) as inter from gt a join dt b on a.video = b.video and a.frame = b.frame group by 1, 2, 3),
ga as (select video, g, sum((x1 - x0) * (y1 - y0)) as ga from gt group by 1, 2), da as (select video, d, sum((x1 - x0) * (y1 - y0)) as da from dt group by 1, 2)
select i.video, i.g, i.d, round(inter / (ga + da - inter), 5) as iou from i join ga using (video, g) join da using (video, d)""")
def f12_track_iou(spark, sf_dir):
    gt, dt = frame_boxes(spark, sf_dir)
    return overlap.track_iou(gt, dt, ["video"], "frame", "g", "d").select("video", "g", "d", F.round("iou", 5).alias("iou"))


@query(f"with {FRAME_SQL} select a.video, a.g, b.d, count(*) as frames, round(max({IOU}), 5) as best from gt a join dt b on a.video = b.video and a.frame = b.frame group by 1, 2, 3")
def j19_group_join(spark, sf_dir):
    gt, dt = frame_boxes(spark, sf_dir)
    return gt.join(dt, ["video", "frame"]).groupBy("video", "g", "d").agg(F.count("*").alias("frames"), F.round(F.max(B.iou_xyxy(F.col("a_box"), F.col("b_box"))), 5).alias("best"))


@query(f"with {BOX_SQL}, p as (select a.brand, a.id as det, b.id as track, round({IOU}, 6) as iou, a.score from box a join box b on a.brand = b.brand and a.id % 2 = 0 and b.id % 2 = 1 and {INTER} > 0), m as (select brand, det, max(iou) as best_iou, arg_max(track, (iou, -track)) as best_track from p where iou >= 0.1 group by 1, 2) select b.id as det, m.best_track, m.best_iou, m.best_track is null and b.score >= 950 as is_new from box b left join m on b.id = m.det and b.brand = m.brand where b.id % 2 = 0")
def j22_associate(spark, sf_dir):
    b = boxes(spark, sf_dir)
    dets, _ = overlap.associate(b.where("id % 2 = 0").withColumnRenamed("id", "det"), b.where("id % 2 = 1").withColumnRenamed("id", "track"), ["brand"], CELL, 0.1, 950)
    return dets.select("det", "best_track", "best_iou", "is_new")


@query(f"with {BOX_SQL}, p as (select a.brand, a.id as a, b.id as b, round(0.3 * (b.score / 3000) + 0.7 * ({IOU}), 6) as c from box a join box b on a.brand = b.brand and a.id <> b.id and {INTER} > 0), q as (select brand, a, round(quantile_cont(c, 0.7), 6) as cut from p group by 1, 2) select a, b, c from p join q using (brand, a) where c > cut and c > 0.4")
def j23_one_to_many(spark, sf_dir):
    a, b = sides(spark, sf_dir)
    return overlap.one_to_many(a, b.withColumn("p", F.col("score") / 3000), ["brand"], CELL, 3, 10).drop("brand")


@query(f"with {FRAME_SQL}, n as (select distinct b.video, b.d from gt a join dt b on a.video = b.video and a.frame = b.frame where {IOU} >= 0.5) select video, d as track from n where not (video % 2 = 0 and d = 1)")
def j29_overlap_gate(spark, sf_dir):
    gt, dt = frame_boxes(spark, sf_dir)
    met = gt.join(dt, ["video", "frame"]).select("video", F.col("d").alias("track"), B.iou_xyxy(F.col("a_box"), F.col("b_box")).alias("iou"))
    tracks = dt.select("video", F.col("d").alias("track")).distinct()
    return overlap.gated_tracks(met, tracks, tracks.where("video % 2 = 0 and track = 1"), ["video"])


def _flat(df):
    return df.select("*", *(F.col("box")[k].alias(n) for k, n in enumerate(match.BOX)))


@query(f"""with recursive {BOX_SQL}, ov as (select a.brand, a.id as a, b.id as b from box a join box b on a.brand = b.brand and a.id <> b.id and a.x0 < b.x1 and b.x0 < a.x1 and a.y0 < b.y1 and b.y0 < a.y1 where {IOU} > 0.2),
o as (select brand, id, score, coalesce(foes, []) as foes, row_number() over (partition by brand order by score desc, id) as rn from box left join (select a as id, list(b) as foes from ov group by 1) using (id)),
k as (select brand, 0::bigint as rn, null::bigint as id, null::double as score, false as keep, []::bigint[] as kept from (select distinct brand from o)
  union all select o.brand, o.rn, o.id, o.score, not list_has_any(kept, foes), case when list_has_any(kept, foes) then kept else list_append(kept, o.id) end from k join o on o.brand = k.brand and o.rn = k.rn + 1)
select brand, id, score from k where keep""")
def n01_box_nms(spark, sf_dir):
    return match.box_nms(boxes(spark, sf_dir), ["brand"], "id", 0.2, 64.0, split=True).where("keep").select("brand", "id", "score")


def scored_tracks(spark, sf_dir):
    return frame_boxes(spark, sf_dir)[1].select("video", "frame", "d", (F.col("d") + 1).cast("double").alias("score"), F.col("b_box").alias("box"))


@query(f"""with {FRAME_SQL}, c as (select a.video, a.frame from dt a join dt b on a.video = b.video and a.frame = b.frame and a.d = 0 and b.d = 1 where {IOU} >= 0.5)
select dt.video, dt.frame, dt.d, not (dt.d = 0 and exists (select 1 from c where c.video = dt.video and c.frame = dt.frame)) as keep from dt""")
def n03_frame_nms(spark, sf_dir):
    """With two tracks, the better one removes the other: so SQL can say it here, though not in general."""
    return match.box_nms(scored_tracks(spark, sf_dir), ["video", "frame"], "d", 0.5, 64.0, inclusive=True).select("video", "frame", "d", "keep")


@query(f"""with {FRAME_SQL}, c as (select a.video from dt a join dt b on a.video = b.video and a.frame = b.frame and a.d = 0 and b.d = 1 group by 1 having sum({INTER}) >= 0.5 * sum({AREA.format('a')} + {AREA.format('b')} - {INTER}))
select video, d, max(not (d = 0 and video in (select video from c))) as keep from dt group by 1, 2""")
def n02_track_nms(spark, sf_dir):
    return match.track_nms(scored_tracks(spark, sf_dir), ["video"], "d", "frame", 0.5).select("video", "d", "keep")


@query()
def j21_assignment(spark, sf_dir):
    b = _flat(boxes(spark, sf_dir)).drop("box")
    gt = b.where("id % 2 = 0").withColumnRenamed("id", "gt_id")
    return match.matched(gt, b.where("id % 2 = 1").withColumnRenamed("id", "dt_id"), ["brand"], "gt_id", "dt_id")


def match_sql(ignored: str) -> str:
    """Matching by brand, one detection after another; ``ignored`` is said of truth ``a``."""
    return f"""ov as (select a.brand, a.id as gt, b.id as dt, {ignored} as ignored, {IOU} as iou from box a join box b on a.brand = b.brand and a.id % 2 = 0 and b.id % 2 = 1 and a.x0 < b.x1 and b.x0 < a.x1 and a.y0 < b.y1 and b.y0 < a.y1),
t as (select unnest([0.1, 0.3, 0.5]::double[]) as iou_thr),
dets as (select box.brand, box.id as dt, any_value(score) as score, iou_thr, row_number() over (partition by box.brand, iou_thr order by any_value(score) desc, box.id) as rn, coalesce(list({{'i': ignored, 'n': -iou, 'g': gt}} order by ignored, iou desc, gt) filter (iou >= iou_thr), []) as near from box cross join t left join ov on ov.brand = box.brand and ov.dt = box.id where box.id % 2 = 1 group by box.brand, box.id, iou_thr),
m as (select brand, iou_thr, 0::bigint as rn, null::bigint as dt_id, null::double as score, null::struct(i boolean, n double, g bigint) as pick, []::bigint[] as taken from (select distinct brand, iou_thr from dets)
  union all select brand, iou_thr, rn, dt, score, pick, case when pick is null then taken else list_append(taken, pick.g) end from (select d.*, m.taken, list_filter(d.near, lambda c: c.i or not list_contains(m.taken, c.g))[1] as pick from m join dets d on d.brand = m.brand and d.iou_thr = m.iou_thr and d.rn = m.rn + 1))"""


@query(f"with recursive {BOX_SQL}, {match_sql('a.id % 10 = 0')} select brand, dt_id, score, iou_thr, pick is not null and not pick.i as matched, coalesce(pick.i, false) as ignored from m where rn > 0")
def n04_coco_match(spark, sf_dir):
    b = _flat(boxes(spark, sf_dir)).drop("box")
    gt = b.where("id % 2 = 0").withColumnRenamed("id", "gt_id").withColumn("ignored", F.col("gt_id") % 10 == 0)
    return match.coco_match(gt, b.where("id % 2 = 1").withColumnRenamed("id", "dt_id"), ["brand"], [0.1, 0.3, 0.5], max_dets=None)


U_SQL = "(('0x' || substr(md5('{0}|' || id), 1, 12))::bigint / 281474976710656.0::double)"


@query(f"""with {BOX_SQL}, m as (select id, x0 + {U_SQL.format('15x')} * (x1 - x0) as px, y0 + {U_SQL.format('15y')} * (y1 - y0) as py, x0 + (2 * {U_SQL.format('160')} - 1) * least(0.1 * (x1 - x0), 5.0) as a, y0 + (2 * {U_SQL.format('161')} - 1) * least(0.1 * (y1 - y0), 5.0) as b, x1 + (2 * {U_SQL.format('162')} - 1) * least(0.1 * (x1 - x0), 5.0) as c, y1 + (2 * {U_SQL.format('163')} - 1) * least(0.1 * (y1 - y0), 5.0) as d from box)
select id, round(px, 6) as px, round(py, 6) as py, round(least(a, c), 6) as x0, round(least(b, d), 6) as y0, round(greatest(a, c), 6) as x1, round(greatest(b, d), 6) as y1 from m""")
def f15_points_and_noise(spark, sf_dir):
    d = boxes(spark, sf_dir).select("id", sampling.point_in(F.col("box"), 15, F.col("id")).alias("p"), sampling.noisy_box(F.col("box"), 0.1, 5.0, 16, F.col("id")).alias("n"))
    return d.select("id", *(r6(F.col("p")[i]).alias(c) for i, c in enumerate(("px", "py"))), *(r6(F.col("n")[i]).alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))))


_COST_SQL = f"""c as (select b.id as target, a.id as pred, a.id // 8 as image,
  2 * -(((a.id * (7 + b.id % 3)) % 10) / 10.0::double) + 5 * (abs(a.x0 + a.x1 - b.x0 - b.x1) / 2 + abs(a.y0 + a.y1 - b.y0 - b.y1) / 2 + abs(a.x1 - a.x0 - b.x1 + b.x0) + abs(a.y1 - a.y0 - b.y1 + b.y0)) / 1000 - 2 * ({IOU} - ({HULL} - ({AREA.format('a')} + {AREA.format('b')} - {INTER})) / {HULL}) as cost
  from box a join box b on a.id // 8 = b.id // 8 and a.id % 8 >= 3 and b.id % 8 < 3)"""


@query(f"""with recursive {BOX_SQL}, {_COST_SQL}, t as (select distinct image, target, dense_rank() over (partition by image order by target) as k from c),
r as (select image, 0::bigint as k, []::bigint[] as preds, []::bigint[] as targets, 0::double as total, []::double[] as costs from (select distinct image from c)
  union all select r.image, t.k, list_append(preds, c.pred), list_append(targets, t.target), total + c.cost, list_append(costs, c.cost) from r join t on t.image = r.image and t.k = r.k + 1 join c on c.image = r.image and c.target = t.target and not list_contains(r.preds, c.pred)),
w as (select image, arg_min({{'p': preds, 't': targets, 'c': costs}}, total) as x from r where k = (select max(k) from t where t.image = r.image) group by image)
select image, unnest(x.p) as pred_id, unnest(x.t) as target_id, round(unnest(x.c), 6) as cost from w""")
def j24_cost_match(spark, sf_dir):
    """Predictions and targets of an image, five and three, matched by class, box distance and generalised IoU."""
    b = boxes(spark, sf_dir).withColumn("image", F.floor(F.col("id") / 8)).withColumn("box", F.transform(B.xyxy_to_cxcywh(F.col("box")), lambda v: v / 1000))
    probs = F.array(*(((F.col("id") * (7 + k)) % 10) / 10.0 for k in range(3)))
    preds = b.where("id % 8 >= 3").select("image", F.col("id").alias("pred_id"), probs.alias("probs"), "box")
    targets = b.where("id % 8 < 3").select("image", F.col("id").alias("target_id"), (F.col("id") % 3).cast("int").alias("label"), "box")
    return match.cost_matched(preds, targets, ["image"], 2.0, 5.0, 2.0).withColumn("cost", r6("cost"))
