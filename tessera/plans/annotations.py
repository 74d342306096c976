"""Annotation tables: orders stand for images or videos, line items for annotations, customers' segments for categories."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions import sampling
from tessera.operators import annotations as A
from tessera.operators import rank
from tessera.plans.common import query, table


@query("select o.o_orderkey, case when count(l.l_orderkey) = 0 then [] else list(l.l_partkey order by l.l_partkey) end as children, count(l.l_orderkey) as n from orders o left join lineitem l on o.o_orderkey = l.l_orderkey group by o.o_orderkey")
def j03_children(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    out = A.with_children(o, li, "o_orderkey", F.col("l_partkey"))
    return out.withColumn("n", F.size("children").cast("long"))


@query("select s.s_suppkey, n.n_name from supplier s join nation n on s.s_nationkey = n.n_nationkey")
def j04_lookup(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return table(spark, sf_dir, "supplier").join(F.broadcast(n), "s_nationkey").select("s_suppkey", "n_name")


@query("select e.vec_id, coalesce(t.prompt, 'class ' || e.label) as prompt from embeddings e left join (select r_regionkey, 'a photo of ' || r_name as prompt from region) t on e.label = t.r_regionkey")
def j05_prompt_or_name(spark, sf_dir):
    own = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("label"), F.concat(F.lit("a photo of "), F.col("r_name")).alias("own"))
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label").join(F.broadcast(own), "label", "left")
    return e.select("vec_id", F.coalesce("own", F.concat(F.lit("class "), F.col("label").cast("string"))).alias("prompt"))


@query("select c.c_nationkey, s.c_mktsegment, count(x.c_custkey) as n from (select distinct c_nationkey from customer) c cross join (select distinct c_mktsegment from customer) s left join customer x on x.c_nationkey = c.c_nationkey and x.c_mktsegment = s.c_mktsegment and x.c_acctbal > 9000 group by 1, 2")
def j06_negatives(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return A.complete(c.select("c_nationkey").distinct(), c.select("c_mktsegment").distinct(), c.where("c_acctbal > 9000"), ["c_nationkey", "c_mktsegment"]).select("c_nationkey", "c_mktsegment", "n")


@query("with k as (select n_nationkey, (row_number() over (order by n_nationkey) - 1) // 4 as chunk from nation), n as (select count(distinct chunk) as chunks from k) select c.c_custkey * n.chunks + k.chunk as datapoint, count(*) as categories from customer c cross join k cross join n group by 1")
def j07_datapoints(spark, sf_dir):
    """Every image with every chunk of the categories; the chunks are a table of a few rows."""
    k = A.chunked(table(spark, sf_dir, "nation").select("n_nationkey"), 4, "n_nationkey").groupBy("chunk").agg(F.count("*").alias("categories"))
    n = k.agg(F.count("*").alias("chunks"))
    c = table(spark, sf_dir, "customer").select("c_custkey").crossJoin(F.broadcast(k.crossJoin(n)))
    return c.select((F.col("c_custkey") * F.col("chunks") + F.col("chunk")).alias("datapoint"), "categories")


@query("select conv_id, unnest(list(turn order by turn)) as frame, 'c' || conv_id % 5 as phrase from conversations group by conv_id")
def j08_frames(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("frames"))
    return c.select("conv_id", F.explode("frames").alias("frame"), F.concat(F.lit("c"), (F.col("conv_id") % 5).cast("string")).alias("phrase"))


@query("select l_orderkey, l_linenumber, count(*) as n from lineitem where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'F') group by 1, 2")
def j09_semi(spark, sf_dir):
    kept = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    (li,) = A.cascade(kept, (table(spark, sf_dir, "lineitem"), "l_orderkey", "o_orderkey"))
    return li.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"))


@query("""with r as (select * from region where r_name <> 'ASIA'), n as (select * from nation where n_regionkey in (select r_regionkey from r)), c as (select * from customer where c_nationkey in (select n_nationkey from n)),
o as (select * from orders where o_custkey in (select c_custkey from c)) select o_orderkey, o_custkey from o""")
def j10_cascade(spark, sf_dir):
    kept = table(spark, sf_dir, "region").where("r_name <> 'ASIA'")
    t = lambda name: table(spark, sf_dir, name)
    *_, orders = A.cascade(kept, (t("nation"), "n_regionkey", "r_regionkey"), (t("customer"), "c_nationkey", "n_nationkey"), (t("orders"), "o_custkey", "c_custkey"))
    return orders.select("o_orderkey", "o_custkey")


@query("select l.l_orderkey, l.l_linenumber, o.o_orderdate as frame_time, count(*) as n from lineitem l join orders o on l.l_orderkey = o.o_orderkey group by all union all select l_orderkey, l_linenumber, null, count(*) from lineitem where l_orderkey not in (select o_orderkey from orders) group by all")
def j11_composite(spark, sf_dir):
    """Composite lookup with misses reported: rows without a parent keep a null."""
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("frame_time"))
    return li.join(o, "l_orderkey", "left").groupBy("l_orderkey", "l_linenumber", "frame_time").agg(F.count("*").alias("n"))


@query("select o.o_orderkey, coalesce(case when o.o_orderkey % 3 = 0 then null else o.o_custkey % 25 end, c.c_nationkey) as nation from orders o left join customer c on o.o_custkey = c.c_custkey")
def j12_fill_key(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey") % 25).alias("c_nationkey"))
    c = table(spark, sf_dir, "customer").withColumn("c_nationkey", F.col("c_nationkey").cast("long"))
    return A.filled(o, c, "c_custkey", ["c_nationkey"]).select("o_orderkey", F.col("c_nationkey").alias("nation"))


@query("select l.l_partkey, l.l_orderkey, count(*) as n, max(coalesce(case when l_linenumber = 1 then null else l_linenumber * 10 end, p.p_size)) as height, max(p_retailprice) as width from lineitem l left join part p on l.l_partkey = p.p_partkey group by 1, 2")
def j13_fill_size(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("p_partkey"), F.when(F.col("l_linenumber") != 1, F.col("l_linenumber") * 10).alias("p_size"), F.lit(None).cast("double").alias("p_retailprice"))
    out = A.filled(li, table(spark, sf_dir, "part"), "p_partkey", ["p_size", "p_retailprice"])
    return out.groupBy(F.col("p_partkey").alias("l_partkey"), "l_orderkey").agg(F.count("*").alias("n"), F.max("p_size").alias("height"), F.max("p_retailprice").alias("width"))


@query("select n_nationkey + (select (min(n_nationkey) = 0)::int from nation) as n_nationkey, n_regionkey + (select (min(n_nationkey) = 0)::int from nation) as n_regionkey from nation")
def j14_reindex(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return A.reindexed(n, ["n_nationkey", "n_regionkey"])


@query("select distinct o_custkey from orders where o_custkey not in (select c_custkey from customer where c_acctbal > 0)")
def j15_subset(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    return A.missing_keys(o, table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k")), ["k"]).select(F.col("k").alias("o_custkey"))


@query("select p.page_id, d.doc_id, d.lang from pages p join documents d on p.page_id = d.doc_id")
def j16_metadata(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page_id"), "doc_id", "lang")
    return table(spark, sf_dir, "pages").select("page_id").join(d, "page_id").select("page_id", "doc_id", "lang")


@query("select o_orderkey, o_orderpriority, count(*) over (partition by o_custkey) as orders_of_customer from orders where o_orderkey in (select min(o_orderkey) from orders group by o_custkey)")
def j26_single(spark, sf_dir):
    """Point lookup of each customer's first order, which must be a single row."""
    o = table(spark, sf_dir, "orders")
    first = o.join(o.groupBy("o_custkey").agg(F.min("o_orderkey").alias("o_orderkey")), ["o_custkey", "o_orderkey"], "left_semi")
    found = A.single(first.select("o_custkey", "o_orderkey", "o_orderpriority"), ["o_custkey"])
    return found.select("o_orderkey", "o_orderpriority", F.col("n_rows").alias("orders_of_customer"))


@query("select l_orderkey, unnest(list(l_quantity order by l_linenumber, l_partkey, l_suppkey, l_quantity)) as quantity, unnest(list(l_partkey order by l_linenumber, l_partkey, l_suppkey, l_quantity)) as part from lineitem group by l_orderkey")
def j27_zip(spark, sf_dir):
    one = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(one)).alias("x"))
    zipped = F.arrays_zip(F.col("x.l_quantity").alias("quantity"), F.col("x.l_partkey").alias("part"))
    return g.select("l_orderkey", F.explode(zipped).alias("z")).select("l_orderkey", F.col("z.quantity").alias("quantity"), F.col("z.part").alias("part"))


@query("select l_orderkey, l_partkey, l_extendedprice, rn from (select *, row_number() over (partition by l_orderkey order by l_extendedprice desc, l_partkey, l_suppkey, l_linenumber) as rn from lineitem) where rn <= 3")
def t03_topk_group(spark, sf_dir):
    top = rank.top_per_group(table(spark, sf_dir, "lineitem"), ["l_orderkey"], 3, F.desc("l_extendedprice"), F.asc("l_partkey"), F.asc("l_suppkey"), F.asc("l_linenumber"))
    return top.select("l_orderkey", "l_partkey", "l_extendedprice", F.col("rn").cast("long").alias("rn"))


@query("with c as (select l_orderkey, count(*) as n from lineitem group by 1) select l_orderkey, least(n, 4) as kept, n > 4 as cut from c")
def t05_limit_when_exceeded(spark, sf_dir):
    top = rank.top_per_group(table(spark, sf_dir, "lineitem"), ["l_orderkey"], 5, F.desc("l_extendedprice"), F.asc("l_partkey"))
    return top.groupBy("l_orderkey").agg(F.least(F.max("rn"), F.lit(4)).cast("long").alias("kept"), (F.max("rn") > 4).alias("cut"))


@query("select user_id, arg_max(event_id, (value, -event_id)) as best from events group by user_id")
def t08_argmax(spark, sf_dir):
    return rank.best_per_group(table(spark, sf_dir, "events"), ["user_id"], F.col("event_id"), F.struct("value", -F.col("event_id")))


@query("with t as (select event_id, user_id, row_number() over (partition by user_id order by value desc, event_id) as rn, user_id % 7 as tracked from events) select event_id, user_id from t where rn <= 10 - tracked")
def t09_object_cap(spark, sf_dir):
    room = F.lit(10) - F.col("user_id") % 7
    top = rank.top_per_group(table(spark, sf_dir, "events"), ["user_id"], 10, F.desc("value"), F.asc("event_id"))
    return top.where(F.col("rn") <= room).select("event_id", "user_id")


@query("select l_orderkey, l_partkey, rn from (select l_orderkey, l_partkey, row_number() over (partition by l_orderkey order by l_returnflag <> 'R', md5('11|' || l_partkey || '|' || l_suppkey || '|' || l_linenumber), l_quantity) as rn from lineitem) where rn <= 4")
def t10_positives_first(spark, sf_dir):
    """Positives first, negatives fill what is left, each in a seeded order."""
    h = sampling.digest(11, F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber"))
    top = rank.top_per_group(table(spark, sf_dir, "lineitem"), ["l_orderkey"], 4, F.asc(F.when(F.col("l_returnflag") == "R", 0).otherwise(1)), h, F.asc("l_quantity"))
    return top.select("l_orderkey", "l_partkey", F.col("rn").cast("long").alias("rn"))


@query("with f as (select distinct turn from conversations where conv_id = 0), k as (select turn from f order by md5('2|' || turn), turn limit 2) select conv_id, turn from conversations where turn in (select turn from k)")
def t11_chosen_once(spark, sf_dir):
    """Chosen on the first conversation, applied to all."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    chosen = c.where("conv_id = 0").select("turn").distinct().orderBy(sampling.digest(2, F.col("turn")), "turn").limit(2)
    return c.join(F.broadcast(chosen), "turn", "left_semi").select("conv_id", "turn")


@query("with t as (select conv_id, turn, row_number() over (partition by conv_id order by turn) - 1 as rn, count(*) over (partition by conv_id) as n from conversations), s as (select *, greatest(1, least(3, (n - 1) // 3)) as stride from t) select conv_id, turn, stride from s where rn % stride = 0 and rn // stride < 4")
def t12_stride(spark, sf_dir):
    """Four frames at a stride of three, or the largest stride that the length allows."""
    w = W.partitionBy("conv_id")
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", (F.row_number().over(w.orderBy("turn")) - 1).alias("rn"), F.count("*").over(w).alias("n"))
    t = t.withColumn("stride", F.greatest(F.lit(1).cast("long"), F.least(F.lit(3).cast("long"), F.floor((F.col("n") - 1) / 3))))
    return t.where((F.col("rn") % F.col("stride") == 0) & (F.floor(F.col("rn") / F.col("stride")) < 4)).select("conv_id", "turn", "stride")


@query("with s as (select event_id, user_id, event_type, event_id % 4 as shard from events), f as (select user_id, event_type, min(shard) as shard from s group by 1, 2) select s.event_id, s.shard from s join f using (user_id, event_type, shard)")
def d01_shard_dedup(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", (F.col("event_id") % 4).alias("shard"))
    return A.first_shard_wins(rows, "shard", ["user_id", "event_type"]).select("event_id", "shard")


@query("with s as (select event_id, user_id, event_type, event_id % 4 as shard from events), f as (select user_id, event_type, min(shard) as first from s group by 1, 2) select user_id, event_type, count(*) as skipped from s join f using (user_id, event_type) where shard > first group by 1, 2")
def d02_skipped_keys(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", (F.col("event_id") % 4).alias("shard"))
    kept = A.first_shard_wins(rows, "shard", ["user_id", "event_type"]).select("event_id")
    return rows.join(kept, "event_id", "left_anti").groupBy("user_id", "event_type").agg(F.count("*").alias("skipped"))


@query("select o_custkey, min(o_orderkey) as first_order from orders group by o_custkey")
def d03_first_of_key(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("first_order"))


@query("select p_partkey from part except select l_partkey from lineitem where l_quantity > 45")
def d05_difference(spark, sf_dir):
    used = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, sf_dir, "part").select("p_partkey").subtract(used)


@query("select doc_id from documents intersect select page_id from pages")
def d06_intersection(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").intersect(table(spark, sf_dir, "pages").select("page_id"))


@query("select distinct l_suppkey, l_returnflag, l_linestatus from lineitem")
def d07_distinct(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query("(select user_id, value, 'stage1' as stage from events where event_type = 'click') union all (select user_id, value, 'stage2' from events where event_type = 'view')")
def d09_stages(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    of = lambda kind, stage: e.where(F.col("event_type") == kind).select("user_id", "value", F.lit(stage).alias("stage"))
    return of("click", "stage1").unionAll(of("view", "stage2"))


@query("with used as (select distinct l_suppkey from lineitem where l_discount > 0.09), m as (select s_suppkey, dense_rank() over (order by s_suppkey) - 1 as new_id from supplier where s_suppkey in (select l_suppkey from used)) select l.l_orderkey, l.l_linenumber, m.new_id, count(*) as n from lineitem l join m on l.l_suppkey = m.s_suppkey where l.l_discount > 0.09 group by all")
def d10_compacted(spark, sf_dir):
    """Unused parents go, the rest are numbered without gaps, and the references follow."""
    li = table(spark, sf_dir, "lineitem").where("l_discount > 0.09")
    kept = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey")).join(li.select("l_suppkey").distinct(), "l_suppkey", "left_semi")
    new = rank.global_rank(kept, F.asc("l_suppkey"), name="k").select("l_suppkey", (F.col("k") - 1).alias("new_id"))
    return li.join(new, "l_suppkey").groupBy("l_orderkey", "l_linenumber", "new_id").agg(F.count("*").alias("n"))


@query("select conv_id, turn, dense_rank() over (partition by conv_id order by turn) - 1 as up, dense_rank() over (partition by conv_id order by turn desc) - 1 as down from conversations")
def w03_stage_ranks(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    up = A.dense_stage(c, ["conv_id"], "turn").withColumnRenamed("stage_rank", "up")
    return A.dense_stage(up, ["conv_id"], "turn", descending=True).select("conv_id", "turn", F.col("up").cast("long").alias("up"), F.col("stage_rank").cast("long").alias("down"))


@query("select conv_id, role, row_number() over (order by role = 'assistant', conv_id, role) as id from (select distinct conv_id, role from conversations)")
def w04_surrogate(spark, sf_dir):
    pairs = table(spark, sf_dir, "conversations").select("conv_id", "role")
    return A.surrogate_ids(pairs, F.asc(F.coalesce(F.col("role") == "assistant", F.lit(False))), F.asc("conv_id"), F.asc("role"))


@query("with p as (select distinct conv_id, turn from conversations), n as (select *, row_number() over (partition by turn order by conv_id) as nth from p), t as (select max(turn) as top from p) select conv_id, turn, turn as new_id from n where nth = 1 union all select conv_id, turn, (select top from t) + row_number() over (order by turn, conv_id) from n where nth > 1")
def w06_unique_ids(spark, sf_dir):
    return A.unique_track_ids(table(spark, sf_dir, "conversations"), "conv_id", "turn")


@query("select o_orderkey, o_custkey, row_number() over (order by o_custkey, o_orderkey) as annotation_id from orders")
def w05_counter(spark, sf_dir):
    return rank.global_rank(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), F.asc("o_custkey"), F.asc("o_orderkey"), name="annotation_id")


@query("select user_id, event_id, sum(case when value >= 50 then 1 else 0 end) over (partition by user_id order by event_id)::bigint - 1 as valid_index from events")
def w10_valid_index(spark, sf_dir):
    w = W.partitionBy("user_id").orderBy("event_id").rowsBetween(W.unboundedPreceding, 0)
    return table(spark, sf_dir, "events").select("user_id", "event_id", (F.sum(F.when(F.col("value") >= 50, 1).otherwise(0)).over(w) - 1).alias("valid_index"))


@query("select user_id, event_type, min(event_id) as first_frame, arg_min(value, event_id) as first_value from events group by 1, 2")
def w13_first_appearance(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("first_frame"), F.min_by("value", "event_id").alias("first_value"))


@query("with t as (select distinct user_id from events), s as (select distinct event_type from events) select t.user_id, s.event_type, coalesce(max(e.value), -1e8) as score from t cross join s left join events e on e.user_id = t.user_id and e.event_type = s.event_type group by 1, 2")
def w14_padded(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    have = e.groupBy("user_id", "event_type").agg(F.max("value").alias("score"))
    spine = e.select("user_id").distinct().crossJoin(F.broadcast(e.select("event_type").distinct()))
    return spine.join(have, ["user_id", "event_type"], "left").withColumn("score", F.coalesce("score", F.lit(-1e8)))


@query("select o_custkey, list(o_orderkey order by o_orderkey) as orders from orders group by o_custkey")
def a09_collected(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list("o_orderkey")).alias("orders"))


@query("select count(distinct l_orderkey) as orders, count(distinct l_orderkey * 1000000 + l_suppkey) as pairs from lineitem")
def a10_distinct_counts(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    pairs = li.select("l_orderkey", "l_suppkey").distinct()
    return pairs.agg(F.count_distinct("l_orderkey").alias("orders"), F.count("*").alias("pairs"))


@query("with c as (select user_id, event_type, count(*) as n from events group by 1, 2), m as (select user_id, arg_min(event_type, (-n, event_type)) as majority from c group by 1) select m.user_id, m.majority, round(avg(e.value), 6) as mean_score from m join events e using (user_id) group by 1, 2")
def a11_mode(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.mode("event_type", True).alias("majority"), F.round(F.avg("value"), 6).alias("mean_score"))


@query("with s as (select event_id, user_id, value, case when event_type = 'view' then 0 else 1 end as stage from events), r as (select *, row_number() over (partition by user_id order by value desc, event_id, stage) as rn from s) select user_id, event_id, stage, rn from r where rn <= 4")
def t04_topk_stages(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "value", "event_type")
    views = F.coalesce(F.col("event_type") == "view", F.lit(False))
    top = rank.topk_of_stages([e.where(views), e.where(~views)], ["user_id"], 4, F.desc("value"), F.asc("event_id"))
    return top.select("user_id", "event_id", "stage", F.col("rn").cast("long").alias("rn"))


@query("select l_orderkey, l_linenumber, l_quantity, row_number() over (partition by l_orderkey order by l_quantity desc, l_linenumber) as rn from lineitem qualify rn <= 2")
def t06_max_detections(spark, sf_dir):
    top = rank.max_detections(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_quantity", "l_linenumber", 2)
    return top.select("l_orderkey", "l_linenumber", "l_quantity", F.col("rn").cast("long").alias("rn"))


@query("with d as (select doc_id, row_number() over (order by doc_id) - 1 as r, count(*) over () as n from documents) select doc_id, i as index, i % 7 as worker from (select doc_id, unnest(generate_series(r, (ceil(n / 7.0) * 7)::bigint - 1, n)) as i from d)")
def r11_wrapped(spark, sf_dir):
    return rank.wrapped_shares(table(spark, sf_dir, "documents").select("doc_id"), 7, F.asc("doc_id")).select("doc_id", F.col("index").cast("long").alias("index"), F.col("worker").cast("long").alias("worker"))


@query("with i as (select event_id, user_id, row_number() over (partition by user_id order by event_id) as k, count(*) over (partition by user_id) as n from events), g as (select distinct user_id, n from i), p as (select user_id, w, row_number() over (partition by user_id order by lv, w) as k from (select user_id, w, unnest(generate_series((user_id * (w + 1)) % 5, (user_id * (w + 1)) % 5 + n - 1)) as lv from g, (select unnest([0, 1, 2, 3]) as w))) select event_id, user_id, w as worker from i join p using (user_id, k)")
def a30_balanced(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id")
    workers = e.select("user_id").distinct().withColumn("worker", F.explode(F.array(*(F.lit(w) for w in range(4))))).withColumn("load", F.col("user_id") * (F.col("worker") + 1) % 5)
    return rank.balanced(e, workers, ["user_id"], F.asc("event_id")).select("event_id", "user_id", "worker")
