"""Metrics: labels and documents stand for truth and detections per image, the frame boxes of the geometry plans for tracks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import boxes as B
from tessera.operators import match
from tessera.operators import metrics as M
from tessera.plans.common import query, r6, table
from tessera.plans.geometry import BOX_SQL, IOU, _flat, boxes, match_sql

KEYS_SQL = """keys as (select l_orderkey as key, t.thr as iou_thr, count(*) filter (l_returnflag = 'R') as n_gt, count(*) filter (l_linestatus = 'F') as n_dt,
 count(*) filter (l_returnflag = 'R' and l_linestatus = 'F' and l_quantity / 50 >= t.thr) as tp from lineitem, (select 0.5::double + 0.05::double * k as thr from range(10) r(k)) t group by 1, 2)"""


def keyed_counts(spark, sf_dir):
    """Truth, detections and matches of each order at each threshold."""
    thr = F.broadcast(spark.createDataFrame([(t,) for t in M.IOU_THRESHOLDS], "iou_thr double"))
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), (F.col("l_returnflag") == "R").alias("g"), (F.col("l_linestatus") == "F").alias("d"), (F.col("l_quantity") / 50).alias("iou"))
    each = li.crossJoin(thr)
    return each.groupBy("key", "iou_thr").agg(F.count_if("g").alias("n_gt"), F.count_if("d").alias("n_dt"), F.count_if(F.col("g") & F.col("d") & (F.col("iou") >= F.col("iou_thr") - 1e-9)).alias("tp"))


CONF = "count(*) filter (n_gt > 0 and n_dt > 0) as tp, count(*) filter (n_gt = 0 and n_dt > 0) as fp, count(*) filter (n_gt > 0 and n_dt = 0) as fn, count(*) filter (n_gt = 0 and n_dt = 0) as tn"
F1 = "(2 * ({0} / ({0} + {1} + 1e-4)) * ({0} / ({0} + {2} + 1e-4)) / ({0} / ({0} + {1} + 1e-4) + {0} / ({0} + {2} + 1e-4) + 1e-4))"


@query(f"with {KEYS_SQL.replace('>= t.thr', '>= t.thr - 1e-9')} select round(iou_thr, 2) as iou_thr, {CONF}, sum(case when n_gt > 0 then tp else 0 end)::bigint as ptp from keys group by 1")
def a13_confusion(spark, sf_dir):
    out = M.classification_gated_f1(keyed_counts(spark, sf_dir))
    return out.select(F.round("iou_thr", 2).alias("iou_thr"), "tp", "fp", "fn", "tn", "ptp")


@query(f"""with {KEYS_SQL.replace('>= t.thr', '>= t.thr - 1e-9')}, s as (select iou_thr, {CONF.replace(' as ', ' as i_')}, sum(case when n_gt > 0 then tp else 0 end)::double as a, sum(case when n_gt > 0 then n_dt - tp else 0 end)::double as b, sum(case when n_gt > 0 then n_gt - tp else 0 end)::double as c,
 avg({F1.format('tp', '(n_dt - tp)', '(n_gt - tp)')}) filter (n_gt > 0 and n_dt > 0) as macro from keys group by 1), m as (select *, (i_tp::double * i_tn - i_fp::double * i_fn) / (sqrt((i_tp + i_fp)::double * (i_tp + i_fn) * (i_tn + i_fp) * (i_tn + i_fn)) + 1e-6) as mcc from s)
select round(iou_thr, 2) as iou_thr, round({F1.format('a', 'b', 'c')}, 5) as micro_f1, round(macro, 5) as macro_f1, round(mcc, 5) as il_mcc, round({F1.format('a', 'b', 'c')} * mcc, 5) as cgf1_micro, round(macro * mcc, 5) as cgf1_macro from m""")
def a14_gated_f1(spark, sf_dir):
    """Both named metrics: micro F1 times MCC, and macro F1 times MCC (A15)."""
    out = M.classification_gated_f1(keyed_counts(spark, sf_dir))
    return out.select(F.round("iou_thr", 2).alias("iou_thr"), *(F.round(c, 5).alias(c) for c in ("micro_f1", "macro_f1", "il_mcc", "cgf1_micro", "cgf1_macro")))


@query(f"with {KEYS_SQL.replace('>= t.thr', '>= t.thr - 1e-9')}, v as (select key, round(iou_thr, 2) as thr, case when n_gt + n_dt > 0 then 2 * tp / (n_gt + n_dt) else 1.0 end as v from keys) select key, round(avg(v), 5) as f1, round(max(v) filter (thr = 0.5), 5) as f1_50, round(max(v) filter (thr = 0.75), 5) as f1_75 from v group by 1")
def a16_key_f1(spark, sf_dir):
    out = M.video_phrase_f1(keyed_counts(spark, sf_dir))
    return out.select("key", *(F.round(c, 5).alias(c) for c in ("f1", "f1_50", "f1_75")))


@query("select user_id, round(sum(value) / count(*), 5) as mean_area, count(*) as frames from (select user_id, case when event_type = 'error' then 0 else value end as value from events) group by 1")
def a12_mean_area(spark, sf_dir):
    """Missing areas count 0 and the frame still counts."""
    g = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_list(F.struct("event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("area"))).alias("fs"))
    total = F.aggregate(F.sort_array("fs"), F.lit(0.0), lambda s, f: s + F.coalesce(f["area"], F.lit(0.0)))
    return g.select("user_id", F.round(total / F.size("fs"), 5).alias("mean_area"), F.size("fs").cast("long").alias("frames"))


@query("with d as (select l_returnflag as cls, l_orderkey::varchar || '.' || l_linenumber || '.' || l_partkey || '.' || l_suppkey || '.' || l_extendedprice as dt_id, l_extendedprice as score, l_quantity > 25 as matched from lineitem where l_orderkey % 10 = l_orderkey % 10 and l_shipdate is not null), u as (select cls, dt_id, max(score) as score, max(matched) as matched from d group by 1, 2), n as (select cls, (count(*) filter (matched) + 100)::bigint as n from u group by 1), r as (select u.cls, dt_id, score, matched, sum(matched::int) over w as tp, count(*) over w as k, n from u join n using (cls) window w as (partition by u.cls order by score desc, dt_id rows unbounded preceding)), b as (select cls, tp / n as r, max(tp / k) over (partition by cls order by score desc, dt_id rows between current row and unbounded following) as p, score, dt_id from r), x as (select *, lag(r) over (partition by cls order by score desc, dt_id) as before from b) select cls, round(sum(p * (floor(r * 100 + 1e-9) - case when before is null then -1 else floor(before * 100 + 1e-9) end)) / 101, 5) as ap from x group by 1")
def a22_average_precision(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").where("l_shipdate is not null")
    name = F.concat_ws(".", *(F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")))
    d = li.groupBy(F.col("l_returnflag").alias("cls"), name.alias("dt_id")).agg(F.max("l_extendedprice").alias("score"), F.max(F.col("l_quantity") > 25).alias("matched"))
    n = d.groupBy("cls").agg((F.count_if("matched") + 100).alias("n"))
    return M.average_precision(d, n, ["cls"]).select("cls", F.round("ap", 5).alias("ap"))


@query("with p as (select event_type, avg(value) as m, sum(value) as s, count(value) as n from events group by 1) select round(avg(m), 5) as macro_avg, round(sum(s) / sum(n), 5) as overall_avg, count(*) as groups from p")
def a23_group_means(spark, sf_dir):
    out = M.group_means(table(spark, sf_dir, "events"), "event_type", "value")
    return out.select(F.round("macro_avg", 5).alias("macro_avg"), F.round("overall_avg", 5).alias("overall_avg"), "groups")


@query("select l_suppkey, count(*) filter (l_discount > 0.05) as n from lineitem group by 1")
def a25_counting(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count_if(F.col("l_discount") > 0.05).alias("n"))


@query("select l_orderkey, count(distinct l_returnflag) = 1 as equal_stages from lineitem group by 1")
def a26_equal_counts(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg((F.count_distinct("l_returnflag") == 1).alias("equal_stages"))


@query("with a as (select user_id as key, round(sum(value), 4) as clicks from events where event_type = 'click' group by 1), b as (select user_id as key, round(sum(value), 4) as views from events where event_type = 'view' group by 1) select coalesce(a.key, b.key) as key, clicks, views from a full outer join b on a.key = b.key")
def a27_merged(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    of = lambda kind, name: e.where(F.col("event_type") == kind).groupBy(F.col("user_id").alias("key")).agg(F.round(F.sum("value"), 4).alias(name))
    return M.merged_metrics(of("click", "clicks"), of("view", "views"), ["key"])


@query("select count(*) as dets, count(distinct l_suppkey) as ids from lineitem")
def a20_counts(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count("*").alias("dets"), F.count_distinct("l_suppkey").alias("ids"))


@query("select count(distinct conv_id) as n from conversations where conv_id in (select conv_id from conversations where role = 'system')")
def a32_tagged(spark, sf_dir):
    """Keys whose rows carry a tag, then only those are combined."""
    g = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_set("role").alias("tags"))
    return g.where(F.array_contains("tags", "system")).agg(F.count("*").alias("n"))


def sequences(spark, sf_dir):
    """Suppliers stand for videos, their orders for frames, with up to three tracks on either side."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("video"), F.col("l_orderkey").alias("frame"), (F.col("l_partkey") % 3).alias("g"), (F.col("l_linenumber") % 3).cast("long").alias("d"), "l_quantity", "l_discount")
    rows = rows.repartition("video", "frame")  # dealt once for all that follows
    of = lambda k: rows.groupBy("video", "frame", k).agg(F.min("l_quantity").alias("q"), F.min("l_discount").alias("s"))
    box = lambda x: F.array(x, F.lit(0.0), x + 20, F.lit(10.0))
    gt = of("g").select("video", "frame", "g", box(F.col("q")).alias("a_box"))
    dt = of("d").select("video", "frame", "d", box(F.col("q") + F.col("s") * 50).alias("b_box"))
    pairs = gt.join(dt, ["video", "frame"]).select("video", "frame", "g", "d", B.iou_xyxy(F.col("a_box"), F.col("b_box")).alias("iou")).where("iou > 0")
    return pairs, gt, dt


@query()
def a17_hota(spark, sf_dir):
    pairs, gt, dt = sequences(spark, sf_dir)
    return M.hota(pairs, gt, dt, "video").select("video", r6("alpha").alias("alpha"), "tp", "fn", "fp", r6("loc").alias("loc"), r6("ass_a").alias("ass_a"), r6("ass_re").alias("ass_re"), r6("ass_pr").alias("ass_pr"))


PARTS_SQL = "p as (select l_orderkey as seq, 0.1 * l_linenumber as alpha, count(*) filter (l_returnflag = 'R') as tp, count(*) filter (l_returnflag = 'A') as fn, count(*) filter (l_returnflag = 'N') as fp, avg(l_discount) as loc, avg(l_tax) as ass_a, avg(l_quantity) / 50 as ass_re, 0.5::double as ass_pr from lineitem group by 1, 2)"


@query(f"""with {PARTS_SQL}, s as (select round(alpha, 1)::double as alpha, sum(tp)::bigint as tp, sum(fn)::bigint as fn, sum(fp)::bigint as fp, sum(loc * tp) / greatest(1, sum(tp)) as loc, sum(ass_a * tp) / greatest(1, sum(tp)) as ass_a from p group by 1)
select alpha, tp, fn, fp, round(loc, 5) as loc, round(tp / greatest(1, tp + fn), 5) as det_re, round(tp / greatest(1, tp + fp), 5) as det_pr, round(sqrt(tp / greatest(1, tp + fn + fp) * ass_a), 5) as hota, round(sqrt(tp / greatest(1, tp + fn) * ass_a), 5) as owta from s""")
def a18_a19_hota_combined(spark, sf_dir):
    flag = F.col("l_returnflag")
    parts = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("seq"), F.round(0.1 * F.col("l_linenumber"), 1).alias("alpha")).agg(F.count_if(flag == "R").alias("tp"), F.count_if(flag == "A").alias("fn"), F.count_if(flag == "N").alias("fp"), F.avg("l_discount").alias("loc"), F.avg("l_tax").alias("ass_a"), (F.avg("l_quantity") / 50).alias("ass_re"), F.lit(0.5).alias("ass_pr"))
    out = M.combined_hota(parts)
    return out.select("alpha", "tp", "fn", "fp", *(F.round(c, 5).alias(c) for c in ("loc", "det_re", "det_pr", "hota", "owta")))


@query("with p as (select l_suppkey as seq, case when l_linenumber % 2 = 0 then 0.5 else 0.75 end::double as iou_thr, count(*) filter (l_returnflag = 'R') as lt, count(*) filter (l_returnflag = 'A') as lf, count(*) filter (l_returnflag = 'N') as lp, count(*) filter (l_discount > 0.05) as ct, count(*) filter (l_discount < 0.02) as cf, count(*) filter (l_tax > 0.05) as cp, avg(l_tax) as a from lineitem group by 1, 2), s as (select iou_thr, sum(lt) / greatest(1, sum(lt + lf + lp)) as loc_a, sum(ct) / greatest(1, sum(ct + cf + cp)) as cls_a, sum(a * lt) / greatest(1, sum(lt)) as assoc_a from p group by 1) select iou_thr, round(loc_a, 5) as loc_a, round(cls_a, 5) as cls_a, round(assoc_a, 5) as assoc_a, round((loc_a + cls_a + assoc_a) / 3, 5) as teta from s")
def a21_teta(spark, sf_dir):
    flag = F.col("l_returnflag")
    thr = F.when(F.col("l_linenumber") % 2 == 0, 0.5).otherwise(0.75)
    parts = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("seq"), thr.alias("iou_thr")).agg(F.count_if(flag == "R").alias("loc_tp"), F.count_if(flag == "A").alias("loc_fn"), F.count_if(flag == "N").alias("loc_fp"), F.count_if(F.col("l_discount") > 0.05).alias("cls_tp"), F.count_if(F.col("l_discount") < 0.02).alias("cls_fn"), F.count_if(F.col("l_tax") > 0.05).alias("cls_fp"), F.avg("l_tax").alias("assoc_a"))
    return M.teta(parts).select("iou_thr", *(F.round(c, 5).alias(c) for c in ("loc_a", "cls_a", "assoc_a", "teta")))


_RANGES = {"all": (0.0, 1e10), "small": (0.0, 1500.0), "medium": (1500.0, 3000.0), "large": (3000.0, 1e10), "none": (1e9, 1e10)}


@query(f"""with recursive {BOX_SQL}, g(area_range, lo, hi) as (values {", ".join(f"('{k}', {lo}::double, {hi}::double)" for k, (lo, hi) in _RANGES.items())}),
rb as (select box.*, area_range, (x1 - x0) * (y1 - y0) < lo or (x1 - x0) * (y1 - y0) >= hi as outside from box, g),
ov as (select a.brand, a.area_range, a.id as gt, b.id as dt, a.id % 10 = 0 or a.outside as ignored, {IOU} as iou from rb a join rb b on a.brand = b.brand and a.area_range = b.area_range and a.id % 2 = 0 and b.id % 2 = 1 and a.x0 < b.x1 and b.x0 < a.x1 and a.y0 < b.y1 and b.y0 < a.y1),
t as (select unnest([0.1, 0.3]::double[]) as iou_thr), l(max_det) as (values (20::bigint), (null)),
dets as (select rb.brand, rb.area_range, rb.id as dt, outside, score, iou_thr, row_number() over (partition by rb.brand, rb.area_range, iou_thr order by score desc, rb.id) as rn, coalesce(list({{'i': ignored, 'n': -iou, 'g': gt}} order by ignored, iou desc, gt) filter (iou >= iou_thr), []) as near from rb cross join t left join ov on ov.brand = rb.brand and ov.area_range = rb.area_range and ov.dt = rb.id where rb.id % 2 = 1 group by rb.brand, rb.area_range, rb.id, outside, score, iou_thr),
m as (select brand, area_range, iou_thr, 0::bigint as rn, null::bigint as dt_id, null::boolean as outside, null::double as score, null::struct(i boolean, n double, g bigint) as pick, []::bigint[] as taken from (select distinct brand, area_range, iou_thr from dets)
  union all select brand, area_range, iou_thr, rn, dt, outside, score, pick, case when pick is null then taken else list_append(taken, pick.g) end from (select d.*, m.taken, list_filter(d.near, lambda c: c.i or not list_contains(m.taken, c.g))[1] as pick from m join dets d on d.brand = m.brand and d.area_range = m.area_range and d.iou_thr = m.iou_thr and d.rn = m.rn + 1)),
n as (select area_range, count(*) filter (not (id % 10 = 0 or outside)) as n from rb where id % 2 = 0 group by 1),
r as (select area_range, max_det, iou_thr, pick is not null as hit, row_number() over w as k, sum((pick is not null)::int) over w as tp from m, l where rn > 0 and rn <= coalesce(max_det, rn) and not coalesce(pick.i, false) and (pick is not null or not outside) window w as (partition by area_range, max_det, iou_thr order by score desc, brand, dt_id)),
b as (select area_range, max_det, iou_thr, floor(tp / n * 100 + 1e-9) as r, max(tp / k) as p from r join n using (area_range) where hit group by all),
c as (select *, max(p) over (partition by area_range, max_det, iou_thr order by r desc) as best, r - coalesce(lead(r) over (partition by area_range, max_det, iou_thr order by r desc), -1) as w from b),
a as (select area_range, max_det, iou_thr, sum(best * w) / 101 as ap from c group by all)
select n.area_range, l.max_det, t.iou_thr, n.n as truths, case when n.n > 0 then round(coalesce(ap, 0), 6) else -1 end as ap from n cross join l cross join t left join a on a.area_range = n.area_range and a.max_det is not distinct from l.max_det and a.iou_thr = t.iou_thr""")
def a22_ap_by_area(spark, sf_dir):
    """Average precision over area ranges and limits of detections, as one table."""
    b = _flat(boxes(spark, sf_dir)).drop("box")
    gt = b.where("id % 2 = 0").withColumnRenamed("id", "gt_id").withColumn("ignored", F.col("gt_id") % 10 == 0)
    out = M.ap_by_area(gt, b.where("id % 2 = 1").withColumnRenamed("id", "dt_id"), ["brand"], [0.1, 0.3], _RANGES, (20, None))
    return out.withColumn("ap", r6("ap"))


@query(f"""with recursive {BOX_SQL}, {match_sql('false')}, n as (select brand, count(*) as n from box where id % 2 = 0 group by 1),
r as (select brand, iou_thr, pick is not null as hit, row_number() over w as k, sum((pick is not null)::int) over w as tp from m where rn > 0 window w as (partition by brand, iou_thr order by score desc, dt_id)),
b as (select brand, iou_thr, floor(tp / n * 100 + 1e-9) as r, max(tp / k) as p from r join n using (brand) where hit group by all),
c as (select *, max(p) over (partition by brand, iou_thr order by r desc) as best, r - coalesce(lead(r) over (partition by brand, iou_thr order by r desc), -1) as w from b)
select brand, iou_thr, round(coalesce(sum(best * w) / 101, 0), 6) as ap from (select distinct brand, iou_thr from r) join n using (brand) left join c using (brand, iou_thr) group by all""")
def a22_coco_ap(spark, sf_dir):
    """Greedy matching per brand, then average precision per threshold."""
    b = _flat(boxes(spark, sf_dir)).drop("box")
    gt = b.where("id % 2 = 0").withColumnRenamed("id", "gt_id").withColumn("ignored", F.lit(False))
    met = match.coco_match(gt, b.where("id % 2 = 1").withColumnRenamed("id", "dt_id"), ["brand"], [0.1, 0.3, 0.5], max_dets=None).where(~F.col("ignored"))
    n = gt.groupBy("brand").agg(F.count("*").alias("n")).crossJoin(F.broadcast(spark.createDataFrame([(0.1,), (0.3,), (0.5,)], "iou_thr double")))
    return M.average_precision(met, n, ["brand", "iou_thr"]).select("brand", "iou_thr", r6("ap").alias("ap"))
