"""Tracker state: users stand for sessions, event ids for frames, event types for objects; an error is a miss."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import overlap
from tessera.plans.common import query, table
from tessera.streaming import folds, windows
from tessera.streaming import tracker as T

FRAMES_SQL = "f as (select user_id as session, event_id as frame, event_id % 3 as obj, event_type not in ('error', 'view') and event_id % 7 <> 0 as matched from events)"


def frames(spark, sf_dir):
    hit = ~F.col("event_type").isin("error", "view") & (F.col("event_id") % 7 != 0)
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("session"), F.col("event_id").alias("frame"), (F.col("event_id") % 3).alias("obj"), hit.alias("matched"))


KEYS = ["session", "obj"]
STREAK_SQL = f"{FRAMES_SQL}, i as (select *, sum(case when matched then 0 else 1 end) over (partition by session, obj order by frame) as island from f), s as (select *, sum(matched::int) over (partition by session, obj, island order by frame)::bigint as streak from i)"


@query(f"with {STREAK_SQL} select session, obj, frame, streak from s")
def w11_streak(spark, sf_dir):
    return T.streaks(frames(spark, sf_dir), KEYS, "frame", "matched").select("session", "obj", "frame", "streak")


@query(f"with {STREAK_SQL} select session, obj, frame, max(streak) over (partition by session, obj order by frame) >= 3 as confirmed from s")
def n10_confirmed(spark, sf_dir):
    return T.confirmed(frames(spark, sf_dir), KEYS, "frame", "matched", 3).select("session", "obj", "frame", "confirmed")


#: Frames of a session lie some hundred ids apart in this table.
RULE = T.HotStart(delay=2000, unmatched=3)
REMOVED_SQL = f"{FRAMES_SQL}, b as (select *, min(frame) over (partition by session, obj) as first from f), m as (select *, sum(case when matched then 0 else 1 end) over (partition by session, obj order by frame) as misses from b where frame < first + 2000), r as (select session, obj, min(frame) as removed_at from m where misses >= 3 group by 1, 2)"


@query(f"with {REMOVED_SQL} select session, obj, removed_at from r")
def n07_hotstart(spark, sf_dir):
    return T.hot_start_removed(frames(spark, sf_dir), KEYS, "frame", "matched", RULE)


@query(f"with {REMOVED_SQL} select f.session, f.obj, f.frame from f left join r using (session, obj) where removed_at is null or removed_at > frame + 1999")
def n16_delayed(spark, sf_dir):
    return T.hot_start_output(frames(spark, sf_dir), KEYS, "frame", "matched", RULE).select("session", "obj", "frame")


@query(f"""with recursive {FRAMES_SQL}, o as (select *, row_number() over (partition by session, obj order by frame) as rn from f),
k as (select session, obj, frame, rn, case when matched then least(8, 1) else greatest(-4, -1) end as keep from o where rn = 1 union all select o.session, o.obj, o.frame, o.rn, case when o.matched then least(8, k.keep + 1) else greatest(-4, k.keep - 1) end from k join o on o.session = k.session and o.obj = k.obj and o.rn = k.rn + 1)
select session, obj, frame, keep, keep <= 0 as suppressed from k""")
def n07_keep_alive(spark, sf_dir):
    return T.keep_alive(frames(spark, sf_dir), KEYS, "frame", "matched").select("session", "obj", "frame", "keep", "suppressed")


@query(f"""with {FRAMES_SQL}, born as (select session, obj, min(frame) as first from f group by 1, 2), p as (select a.session, a.obj, b.obj as other, a.frame from f a join f b on a.session = b.session and a.obj <> b.obj and a.frame // 50 = b.frame // 50 and a.matched and b.matched)
select session, other as obj from p join born x using (session, obj) join born y on y.session = p.session and y.obj = p.other where y.first > x.first and p.frame < y.first + 2000 group by 1, 2, p.obj having false
union select session, obj from (select p.session, p.other as obj, count(distinct p.frame) as n from p join born x on x.session = p.session and x.obj = p.obj join born y on y.session = p.session and y.obj = p.other where y.first > x.first and p.frame < y.first + 2000 group by 1, 2) where n >= 2""")
def n08_duplicates(spark, sf_dir):
    f = frames(spark, sf_dir)
    born = f.groupBy(*KEYS).agg(F.min("frame").alias("first"))
    seen = f.where("matched").withColumn("at", F.floor(F.col("frame") / 50))
    pairs = seen.select("session", "at", "obj", "frame").join(seen.select("session", "at", F.col("obj").alias("other")), ["session", "at"]).where("obj <> other").select("session", "obj", "other", "frame")
    return T.duplicates(pairs, ["session"], "frame", born, 2, 2000)


@query(f"with {STREAK_SQL}, c as (select *, max(streak) over (partition by session, obj order by frame) >= 2 as confirmed, row_number() over (partition by session, obj order by frame) as at, count(*) over (partition by session, obj) as last from s) select a.session, a.obj, a.frame, b.confirmed as shown from c a join c b on a.session = b.session and a.obj = b.obj and b.at = least(a.at + 2, a.last)")
def n17_look_ahead(spark, sf_dir):
    from pyspark.sql import Window as W

    w = W.partitionBy(*KEYS)
    c = T.confirmed(frames(spark, sf_dir), KEYS, "frame", "matched", 2)
    c = c.withColumn("at", F.row_number().over(w.orderBy("frame"))).withColumn("last", F.count("*").over(w))
    return T.look_ahead(c, KEYS, "at", 3, "last").select("session", "obj", "frame", "shown")


@query(f"with {REMOVED_SQL} select f.session, f.obj, f.frame from f join events e on e.event_id = f.frame where e.value > 0 and not exists (select 1 from r where r.session = f.session and r.obj = f.obj) and not (f.obj = 2 and f.session % 5 = 0)")
def n18_visible(spark, sf_dir):
    f = frames(spark, sf_dir)
    rows = f.join(table(spark, sf_dir, "events").select(F.col("event_id").alias("frame"), F.col("value").alias("area")), "frame")
    removed = T.hot_start_removed(f, KEYS, "frame", "matched", RULE)
    return T.visible(rows, [removed, f.where("obj = 2 and session % 5 = 0")], KEYS).select("session", "obj", "frame")


@query("""with a as (select user_id as session, event_id as frame, case event_type when 'purchase' then 'propagate' when 'error' then 'add' else 'refine' end as action, event_id % 4 as obj from events),
t as (select *, coalesce(sum((action = 'propagate')::int) over (partition by session order by frame rows between unbounded preceding and 1 preceding), 0) as turn from a),
g as (select session, turn, max(case when action = 'propagate' then frame end) as frame, max(action = 'add') as added, list_sort(list(distinct obj) filter (action = 'refine')) as objs from t group by 1, 2)
select session, frame, case when added then 'full' when len(coalesce(objs, [])) > 0 then 'partial' else 'fetch' end as mode, case when not added and len(coalesce(objs, [])) > 0 then objs else [] end as objs from g where frame is not null""")
def n19_propagation(spark, sf_dir):
    action = F.when(F.col("event_type") == "purchase", "propagate").when(F.col("event_type") == "error", "add").otherwise("refine")
    a = table(spark, sf_dir, "events").select(F.col("user_id").alias("session"), F.col("event_id").alias("frame"), action.alias("action"), (F.col("event_id") % 4).alias("obj"))
    return T.propagation(a, "session", "frame")


@query("with p as (select conv_id, min(turn) filter (role = 'assistant') as start, max(turn) as last from conversations group by 1) select conv_id, start, range(start, last + 1) as forward, list_reverse(range(0, start + 1)) as backward from p where start is not null")
def n20_processing_range(spark, sf_dir):
    p = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.min(F.when(F.col("role") == "assistant", F.col("turn"))).alias("start"), F.max("turn").alias("last")).where(F.col("start").isNotNull())
    return p.select("conv_id", "start", F.sequence("start", "last").alias("forward"), F.reverse(F.sequence(F.lit(0).cast("long"), "start")).alias("backward"))


_SEEN = "f as (select user_id as session, epoch_us(ts) // 86400000000 - 19723 as frame, event_id % 5 as obj, min(event_type) as kind, round(max(value), 3) as v from events group by all)"


def seen(spark, sf_dir):
    """Days stand for frames: the objects that a session shows on a day."""
    e = table(spark, sf_dir, "events")
    day = F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).cast("long")
    return e.groupBy(F.col("user_id").alias("session"), day.alias("frame"), (F.col("event_id") % 5).alias("obj")).agg(F.min("event_type").alias("kind"), F.round(F.max("value"), 3).alias("v"))


@query(f"""with recursive {_SEEN}, o as (select x.session, x.frame, x.obj, x.v < 15 as occluded, x.kind = 'error' as removed, coalesce(list(y.obj) filter (y.obj is not null), []) as foes from f x left join f y on x.session = y.session and x.frame = y.frame and x.obj <> y.obj and abs(x.v - y.v) < 40 group by all),
g as (select session, frame, row_number() over (partition by session order by frame) as rn, list({{'obj': obj, 'occluded': occluded, 'removed': removed, 'foes': foes}} order by obj) as objs from o group by 1, 2),
r as (select session, null::bigint as frame, 0::bigint as rn, []::struct(obj bigint, occluded boolean, removed boolean, foes bigint[])[] as objs, map([]::bigint[], []::bigint[]) as now, []::boolean[] as gone from (select distinct session from g)
  union all select session, frame, rn, objs, map(list_transform(objs, lambda x: x.obj), list_transform(objs, lambda x, i: case when x.occluded or gone[i] then frame else was[x.obj] end)), gone
  from (select *, list_transform(objs, lambda x: len(list_filter(x.foes, lambda y: was[y] > -1 and was[x.obj] > was[y])) > 0) as gone
    from (select g.session, g.frame, g.rn, g.objs, map(list_transform(g.objs, lambda x: x.obj), list_transform(g.objs, lambda x: coalesce(r.now[x.obj], case when x.removed then 100000 else -1 end))) as was from r join g on g.session = r.session and g.rn = r.rn + 1)))
select session, frame, x.obj as obj, gone[i] as suppressed, now[x.obj] as last_occluded from (select session, frame, now, gone, unnest(objs) as x, generate_subscripts(objs, 1) as i from r where rn > 0)""")
def n09_recent_occlusion(spark, sf_dir):
    """Of two overlapping objects the one occluded more recently is suppressed; what was occluded when goes from frame to frame."""
    f = seen(spark, sf_dir)
    other = f.select("session", "frame", F.col("obj").alias("foe"), F.col("v").alias("w"))
    near = f.join(other, ["session", "frame"]).where((F.col("obj") != F.col("foe")) & (F.abs(F.col("v") - F.col("w")) < 40)).groupBy("session", "frame", "obj").agg(F.collect_list("foe").alias("foes"))
    rows = f.join(near, ["session", "frame", "obj"], "left").withColumn("occluded", F.col("v") < 15).withColumn("removed", F.col("kind") == "error")
    return folds.rule_table(rows, folds.RecentOcclusion())


_IOU = "greatest(0, least({0}[3], {1}[3]) - greatest({0}[1], {1}[1])) * greatest(0, least({0}[4], {1}[4]) - greatest({0}[2], {1}[2]))"


@query(f"""with recursive {_SEEN}, o as (select session, frame, obj, [v, obj, v + 30, obj + 10]::double[] as box, case when kind in ('click', 'view') then 0.9 else 0.5 end as score, case when kind <> 'signup' then 0.9 else 0.3 end as own from f),
g as (select session, frame, row_number() over (partition by session order by frame) as rn, list({{'obj': obj, 'box': box, 'score': score, 'own': own}} order by obj) as objs from o group by 1, 2),
r as (select session, null::bigint as frame, 0::bigint as rn, []::struct(obj bigint, box double[], score double, own double)[] as objs, map([]::bigint[], []::double[][]) as boxes, map([]::bigint[], []::bigint[]) as ages, []::boolean[] as off, []::boolean[] as renewed from (select distinct session from g)
  union all select session, frame, rn, objs,
    map_concat(boxes, map(list_transform(objs, lambda x: x.obj), list_transform(objs, lambda x, i: case when renewed[i] or boxes[x.obj] is null then x.box else boxes[x.obj] end))),
    map_concat(ages, map(list_transform(objs, lambda x: x.obj), list_transform(objs, lambda x, i: case when renewed[i] or boxes[x.obj] is null then 0 else ages[x.obj] + 1 end))), off, renewed
  from (select *, list_transform(objs, lambda x: (frame % 8 = 0 or list_contains(off, true)) and boxes[x.obj] is not null and x.own > 0.8) as renewed
    from (select g.session, g.frame, g.rn, g.objs, r.boxes, r.ages, list_transform(g.objs, lambda x: coalesce(x.score >= 0.8 and {_IOU.format('x.box', 'r.boxes[x.obj]')} / (600 - {_IOU.format('x.box', 'r.boxes[x.obj]')}) < 0.2, false)) as off from r join g on g.session = r.session and g.rn = r.rn + 1)))
select session, frame, x.obj as obj, off[i] as mismatched, renewed[i] as reconditioned, ages[x.obj] as age from (select session, frame, ages, off, renewed, unnest(objs) as x, generate_subscripts(objs, 1) as i from r where rn > 0)""")
def n11_recondition(spark, sf_dir):
    """Boxes stored from frame to frame, renewed on every eighth one or when a sure detection has left them."""
    at = F.col("v")
    rows = seen(spark, sf_dir).select("session", "frame", "obj", at.alias("x0"), F.col("obj").cast("double").alias("y0"), (at + 30).alias("x1"), (F.col("obj") + 10).cast("double").alias("y1"), F.when(F.col("kind").isin("click", "view"), 0.9).otherwise(0.5).alias("score"), F.when(F.col("kind") != "signup", 0.9).otherwise(0.3).alias("own_score"))
    return folds.rule_table(rows, folds.Reconditioning(every=8, iou=0.2, area=300.0))


@query("with r as (select user_id, event_id, event_type, case when lag(event_type) over w is not distinct from event_type then 0 else 1 end as c from events window w as (partition by user_id order by event_id)), n as (select *, sum(c) over (partition by user_id order by event_id)::bigint as run from r) select user_id, run, min(event_type) as value, min(event_id) as start, count(*) as length from n group by 1, 2")
def w12_run_lengths(spark, sf_dir):
    return overlap.change_points(table(spark, sf_dir, "events"), ["user_id"], "event_id", F.col("event_type"))


@query("select time_bucket(interval '1 day', ts) as start, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2")
def st_tumbling(spark, sf_dir):
    out = windows.tumbling(windows.with_event_time(table(spark, sf_dir, "events")), "1 day", ["event_type"])
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("with w as (select time_bucket(interval '6 hours', ts) - k * interval '6 hours' as start, event_type from events, range(4) r(k)) select start, event_type, count(*) as n from w group by 1, 2")
def st_sliding(spark, sf_dir):
    out = windows.sliding(windows.with_event_time(table(spark, sf_dir, "events")), "1 day", "6 hours", ["event_type"])
    return out.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("with g as (select user_id, ts, case when ts < lag(ts) over w + interval '6 hours' then 0 else 1 end as c from events window w as (partition by user_id order by ts)), s as (select *, sum(c) over (partition by user_id order by ts) as k from g) select user_id, min(ts) as start, max(ts) + interval '6 hours' as \"end\", count(*) as n from s group by user_id, k")
def st_session(spark, sf_dir):
    out = windows.sessions(windows.with_event_time(table(spark, sf_dir, "events")), "6 hours", "user_id")
    return out.withColumn("start", F.col("start").cast("timestamp_ntz")).withColumn("end", F.col("end").cast("timestamp_ntz"))
